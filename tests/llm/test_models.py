import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from readloom.llm import brown
from readloom.llm.brown import Shape, score
from readloom.llm.kneser_ney import END, LOW, START, fit, grams_of, hash_of, judge_quality, log10_probabilities, log_probability
from readloom.llm.queries import QUERIES, fold
from readloom.llm.scratch import Scratch
from readloom.llm.toxicity import Shape as ToxicityShape
from readloom.llm.toxicity import calibrated, score_toxicity, words_of

from .helpers import SF, crc, documents, sf_texts, words


def base_scores(texts, held):
    tokens = {i: [*words(t, lower=True), b""] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if not held(i) for w in ws)
    total, types = sum(counts.values()), len(counts)
    return {i: (held(i), len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ws)) for i, ws in tokens.items()}


def same(rows, want):
    for r in rows:
        *exact, value = want[r.doc_id]
        assert [r.held_out, r.n_tokens, r.n_known, r.train_tokens] == exact
        assert math.isclose(r.base_score, value, rel_tol=1e-9)
        assert r.score <= 0 and math.isfinite(r.score)
    assert len(rows) == len(want)


def test_brown_query(spark):
    rows = QUERIES["op1_brown_score"](spark, SF).collect()
    same(rows, base_scores(sf_texts(spark), lambda i: crc(i) % 7 == 2))
    apart = [r for r in rows if r.held_out]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart)


def test_brown_edges(spark):
    texts = {1: None, 2: "", 3: "One two three two one", 4: "ONE two unheard", 5: "é " * 5000, 6: "a" * 50_000}
    for held in (lambda i: i == 4, lambda i: True, lambda i: False):
        flag = F.col("doc_id").isin([i for i in texts if held(i)])
        same(score(documents(spark, texts), flag, shape=Shape(16, 4, 3)).collect(), base_scores(texts, held))
    assert score(documents(spark, texts).limit(0), F.lit(False)).count() == 0
    twice = documents(spark, {1: "a b"}).union(documents(spark, {1: "a b"}))
    assert [r.train_tokens for r in score(twice, F.lit(None).cast("boolean"), shape=Shape(16, 4, 1)).collect()] == [6, 6]


def test_classes_tell_topics_apart(spark):
    """Two sorts of texts with words of their own: class bigrams must beat single words by about a bit for each word."""
    rng = random.Random(8)
    topics = [[f"{c}{rng.randrange(10**6)}" for _ in range(60)] for c in "xy"]
    texts = {i: " ".join(rng.choice(topics[i % 2]) for _ in range(80)) for i in range(120)}
    rows = [r for r in score(documents(spark, texts), F.col("doc_id") >= 100, shape=Shape(200, 6, 8)).collect() if r.held_out]
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    assert gain > 0.25


def test_scores_against_a_plain_version(spark):
    """With one class, a text's score is that of an order of words and ends, and of words by their counts."""
    rng = random.Random(9)
    texts = {i: " ".join(rng.choice("abcdefgh") + rng.choice("xy") for _ in range(rng.randint(0, 9))) for i in range(40)} | {50: None, 51: "never heard", 52: "ax " * 3000}
    held = lambda i: i % 5 == 0 or i == 51
    docs = documents(spark, texts)
    docs = docs.union(docs.filter("doc_id = 3")).withColumn("doc_id", F.col("doc_id").cast("string"))  # a repeated row, and ids that are no numbers
    learnt = [words(texts[i], lower=True) for i in [*texts, 3] if not held(i)]
    counts = Counter(w for ws in learnt for w in ws)
    n, once = sum(counts.values()), sum(c == 1 for c in counts.values())
    share = (once + 0.5) / (n + 1)
    grid = np.zeros((2, 2))
    for ws in learnt:
        seen = [1, *([0] * len(ws)), 1]
        for a, b in zip(seen, seen[1:], strict=False):
            grid[a, b] += 1
    prior = (grid.sum(0) + 1) / (grid.sum() + 2)
    after = np.log10((grid + 2 * prior) / (grid.sum(1, keepdims=True) + 2))

    def plain(text):
        ws = words(text, lower=True)
        seen = [1, *([0] * len(ws)), 1]
        order = sum(after[a, b] for a, b in zip(seen, seen[1:], strict=False))
        return order + sum(math.log10((1 - share) * counts[w] / n) if counts[w] else math.log10(share) for w in ws)

    flag = (F.col("doc_id").cast("int") % 5 == 0) | (F.col("doc_id") == "51")
    for core in (0, 4):
        rows = score(docs, flag, shape=Shape(core=core, classes=1)).collect()
        assert sorted(r.doc_id for r in rows) == sorted([*map(str, texts), "3"])
        assert all(math.isclose(r.score, plain(texts[int(r.doc_id)]), rel_tol=1e-9) for r in rows)


def test_all_words_are_exchanged(spark):
    """Rare words, none of them a core word and all of one ending, go to the class of the company they keep."""
    rng = random.Random(2)
    frames = [[f"{c}{i}" for i in range(6)] for c in "pq"]

    def text(i):
        frame = frames[i % 2]
        return " ".join(x for j in range(30) for x in (*rng.choices(frame, k=3), f"{'pq'[i % 2]}{(i // 2 + 3 * j) % 90}ing"))

    texts = {i: text(i) for i in range(120)}
    gains = []
    for least in (1.0, 1e9):  # with the exchange of rare words, and without
        rows = [r for r in score(documents(spark, texts), F.col("doc_id") >= 100, shape=Shape(12, 1, 4, 8, least)).collect() if r.held_out]
        gains.append(sum(r.score for r in rows) / sum(r.n_tokens for r in rows))
    assert gains[0] > gains[1] + 0.05


def test_kneser_ney_is_a_distribution(spark):
    """After any context, the probabilities of all known words and of one unknown word add up to one."""
    docs = documents(spark, ["a b c a b d", "a b c", "d d a b", "c a", "b b b a c d"], extra=False).selectExpr("doc_id as id", "text")
    tables, unseen = fit(docs, Scratch(spark))
    known = [b"a", b"b", b"c", b"d", END]

    def after(first, second, last):
        keys = grams_of([b" ".join((first, second, last))])
        at = next(i for i in range(len(keys[0])) if i == 2)
        tables_of = [tables["g3"], tables["c2"], tables["g2"], tables["c1"], tables["w"]]
        found = [dict(zip(k.tolist(), v.tolist(), strict=True)).get(int(x[at])) for (k, v), x in zip(tables_of, keys, strict=False)]
        if found[0] is not None:
            return 10 ** found[0]
        below = found[2] if found[2] is not None else (found[3] or 0.0) + (found[4] if found[4] is not None else unseen)
        return 10 ** ((found[1] or 0.0) + below)

    for context in ((b"a", b"b"), (b"d", b"d"), (b"c", b"zz"), (b"zz", b"zz")):
        ending = 1 - sum(after(*context, w) for w in [*known[:-1], b"unknown"])
        assert 0 <= ending < 1
    assert START not in known
    values, n = log_probability(tables, unseen, [b"a b c", b"", b"zz"])
    assert n.tolist() == [4, 1, 2] and values[0] > 4 * values[2] / 2


def test_quality_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_kneser_ney"](spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = [np.mean([rows[i].kept for i, q in labels.items() if q == good]) for good in (0, 1)]
    assert kept[1] > 0.97 and kept[0] < 0.5
    assert len({(r.lang, r.threshold) for r in rows.values()}) == len({r.lang for r in rows.values()})


def test_quality_edges(spark):
    texts = {i: f"some plain text number {i % 7} of a few words" for i in range(40)} | {100: None, 101: "", 102: "%% && zz " * 40, 103: "x" * 100_000}
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in judge_quality(docs, labels).collect()}
    assert len(got) == len(texts) and got[100].perplexity is None and not got[101].kept
    assert got[3].kept and not got[102].kept
    assert judge_quality(docs.limit(0), labels).count() == 0
    assert all(r.kept for r in judge_quality(docs.filter("doc_id < 40"), labels.limit(0)).collect())


def test_quality_learns_from_all_trusted_text(spark):
    """7 MB of trusted text in long words: scores are those of a model of all of it but the fifth that is held apart."""
    texts = {i: " ".join(f"{i % 690}-{i % 7 if j % 4 == 0 else j}".ljust(1000, "z") for j in range(10)) for i in range(700)}
    docs = documents(spark, texts).withColumn("lang", F.lit("en"))
    labels = docs.selectExpr("doc_id", "1 as quality")
    got = {r.doc_id: r.perplexity for r in judge_quality(docs, labels).collect()}
    usable = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(5)) != 0)
    learnt = {r.doc_id for r in usable.select("doc_id").collect()}
    assert sum(len(texts[i]) for i in learnt) > 4 << 20
    tables, unseen = fit(usable.selectExpr("doc_id as id", "text"), Scratch(spark))
    values, n = log_probability(tables, unseen, [t.encode() for t in texts.values()])
    assert all(math.isclose(got[i], 10 ** (-v / k), rel_tol=1e-6) for i, v, k in zip(texts, values, n, strict=True))


def plain_kneser_ney(learnt):
    """log10 probability and number of tokens of a text, from plain counters."""
    padded = lambda t: [START, START, *t.lower().encode().split(), END]
    three = Counter(x for t in learnt for x in zip(*(padded(t)[i:] for i in range(3)), strict=False))
    two, one = Counter(x[1:] for x in three), Counter()
    for x in two:
        one[x[1]] += 1

    def levels(counts):
        n1, n2, n3, n4 = (sum(v == i for v in counts.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        return [min(max(i - (i + 1) * y * b / a, 0.1), float(i)) if a else 0.75 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]

    given = {id(c): levels(c) for c in (one, two, three)}
    taken = lambda c, n: given[id(c)][min(n, 3) - 1]
    sums = {}
    for c in (two, three):
        for x, n in c.items():
            total, left = sums.get(x[:-1], (0, 0.0))
            sums[x[:-1]] = total + n, left + taken(c, n)
    total, left = sum(one.values()), sum(taken(one, n) for n in one.values())

    def p(x):
        if len(x) == 1:
            n = one[x[0]]
            return (n - taken(one, n) if n else 0) / total + left / total / (len(one) + 1)
        if x[:-1] not in sums:
            return p(x[1:])
        c = three if len(x) == 3 else two
        n, (all_, rest) = c[x], sums[x[:-1]]
        return ((n - taken(c, n) if n else 0) + rest * p(x[1:])) / all_

    return lambda t: (sum(math.log10(p(x)) for x in zip(*(padded(t)[i:] for i in range(3)), strict=False)), len(padded(t)) - 2)


@pytest.mark.parametrize(("slices", "groups", "shared"), [(1, 1, 0), (4, 3, 0), (4, 3, 8)])
def test_kneser_ney_against_plain_counters(spark, monkeypatch, slices, groups, shared):
    """Whatever the slices and groups are, and however frequent words are shared, texts have the values of the whole model."""
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    texts = [" ".join(words[i : i + 25]) for i in range(0, 3000, 25)] + ["", "W1  w1\tw1 never", "x" * 200 + " w2", words[0]]
    learnt = texts[:80] + texts[-1:]
    plain = plain_kneser_ney(learnt)
    rows = [(t, i < 80 or i == len(texts) - 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[90], rows[90]], "text string, usable boolean").withColumn("id", F.xxhash64("text")).repartition(3)
    hot = {hash_of(w) & int(LOW): shared for w in (b"w1", b"w2", b"never", START)} if shared else {}
    monkeypatch.setattr("readloom.llm.kneser_ney.GROUP_TOKENS", max(1, sum(map(len, texts)) // 6 // slices // (groups - 1)) if groups > 1 else 1 << 19)
    monkeypatch.setattr("readloom.llm.kneser_ney.BLOCK_BYTES", 500)
    scratch = Scratch(spark)
    got = {r.h: r for r in log10_probabilities(docs, scratch, slices, hot).collect()}
    assert len(got) == len(set(texts))
    for r in docs.collect():
        value, n = plain(r.text)
        assert got[r.id].n == n and math.isclose(got[r.id].value, value, rel_tol=1e-9)


def test_quality_keeps_no_texts(spark, monkeypatch, tmp_path):
    """Texts are not written beside their n-grams, so what a run leaves is smaller than they are."""
    monkeypatch.setattr("readloom.llm.scratch.folder", lambda _: str(tmp_path / "kept"))
    rng = random.Random(5)
    docs = documents(spark, {i: " ".join(str(rng.randrange(10**9)) for _ in range(500)) for i in range(400)}).withColumn("lang", F.lit("en"))
    labels = docs.filter("doc_id % 8 = 0").selectExpr("doc_id", "1 as quality")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert judge_quality(docs, labels).count() == 400
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 0.4 * size


def test_toxicity_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    assert {i: r.held_out for i, r in rows.items()} == {i: crc(i) % 4 == 2 for i in rows}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = [(rows[r.doc_id].score, r.toxic) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if rows[r.doc_id].held_out]
    good, bad = ([s for s, t in labels if t == x] for x in (0, 1))
    assert np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good]) > 0.85


def test_toxicity_edges(spark):
    rng = random.Random(1)
    plain = [f"w{i}" for i in range(50)]
    texts = {i: " ".join([*rng.choices(plain, k=30), *(["vile", "vilest"] if i % 4 == 0 else [])]) for i in range(200)} | {900: None, 901: "", 902: "vile", 903: "ok " * 50_000, 904: "vilely " * 20}
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(documents(spark, texts), labels, F.col("doc_id") >= 150).collect()}
    assert len(got) == len(texts) and got[152].predicted == 1 and got[153].predicted == 0
    assert got[900].score == got[901].score < 0.3 and got[903].predicted == 0 and got[904].score > 0.5
    assert {r.score for r in score_toxicity(documents(spark, texts), labels.limit(0), F.lit(False)).collect()} == {0.0}
    assert score_toxicity(documents(spark, texts).limit(0), labels, F.lit(False)).count() == 0


def plain_values(learnt, texts, shape):
    """Log-likelihood ratio for each word of each text, by a plain version of the two class models."""
    most, d, own_d = shape.letters, shape.discount, shape.class_discount
    counts = Counter(), Counter()
    for label, text in learnt:
        counts[label].update({w.decode() for w in words_of((text or "").encode())})

    def places(word):
        s = f" {word} "
        return [s[max(0, i - most) : i] for i in range(2, len(s) + 1)]

    grams = Counter(), Counter()
    for c in (0, 1):
        for w, n in counts[c].items():
            for g in places(w):
                grams[c][g] += n
    both = grams[0] + grams[1]
    low, longer = {}, {g for g in both if len(g) == most}
    for m in range(most - 1, 0, -1):
        low[m] = Counter(g[1:] for g in longer) + Counter(g for g in both if len(g) == m)
        longer = set(low[m])
    contexts = {m: (Counter(), Counter()) for m in (*low, most)}
    for m, table in (*low.items(), (most, both)):
        for g, n in table.items():
            contexts[m][0][g[:-1]] += n
            contexts[m][1][g[:-1]] += 1

    def interpolated(g, m, table):
        """The shared probability of a known n-gram's last letter."""
        total, kinds = contexts[m][0][g[:-1]], contexts[m][1][g[:-1]]
        below = 1 / (max(1, len(low[1])) + 1) if len(g) == 1 else interpolated(g[1:], len(g) - 1, low[len(g) - 1])
        return max(table[g] - d, 0) / total + d * kinds / total * below

    def left(c, h):
        own = [n for g, n in grams[c].items() if g[:-1] == h]
        return sum(min(n, own_d) for n in own) / sum(own) if own else 1.0

    def ratio(g):
        if g in both:
            shared = interpolated(g, most, both)
            p = [max(grams[c][g] - own_d, 0) / max(1, sum(n for x, n in grams[c].items() if x[:-1] == g[:-1])) + left(c, g[:-1]) * shared for c in (0, 1)]
            return math.log(p[1] / p[0])
        return math.log(left(1, g[:-1]) / left(0, g[:-1])) if any(x[:-1] == g[:-1] for x in both) else 0.0

    def value(text):
        ws = [w.decode() for w in words_of((text or "").encode())]
        return sum(math.log(1 + shape.share * (math.exp(sum(map(ratio, places(w)))) - 1)) for w in ws) / len(ws) if ws else 0.0

    return {i: value(t) for i, t in texts.items()}


def test_toxicity_against_a_plain_version(spark):
    rng = random.Random(5)
    plain, bad = ["green", "greens", "tree", "house", "mouse", "water", "é"], ["vile", "vilest", "rot"]
    texts = {i: " ".join(rng.choices(plain, k=rng.randint(1, 12)) + (rng.choices(bad, k=2) if i % 3 == 0 else [])) for i in range(60)}
    texts |= {100: "Vilely, rotten trees", 101: "housing waters", 102: None, 103: "zz"}
    docs = documents(spark, texts)
    docs = docs.union(docs.filter("doc_id < 6"))  # repeated rows
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(50)], "doc_id long, toxic int")
    shape = ToxicityShape(letters=4)
    apart = {r.doc_id: r.apart for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(5)) == 0).alias("apart")).collect()}
    known = [i for i in [*range(50), *range(6)] if i < 45]
    values = plain_values([(int(i % 3 == 0), texts[i]) for i in known if not apart[i]], texts, shape)
    kept = [i for i in known if apart[i]]
    slope, middle = calibrated(np.asarray([values[i] for i in kept]), np.asarray([float(i % 3 == 0) for i in kept]))
    rows = score_toxicity(docs, labels, F.col("doc_id") >= 45, shape=shape).collect()
    assert len(rows) == len(texts) + 6
    for r in rows:
        assert math.isclose(r.score, 1 / (1 + math.exp(-(slope * values[r.doc_id] + middle))), rel_tol=1e-6, abs_tol=1e-9)


def test_brown_scores_do_not_depend_on_the_split(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    told = lambda n: {r.doc_id: r for r in score(docs.repartition(n), fold(7) == 2, shape=Shape(core=512, classes=16, rounds=3)).collect()}
    one, many = told(1), told(32)
    for name in ("n_tokens", "n_known", "train_tokens"):
        assert {i: r[name] for i, r in one.items()} == {i: r[name] for i, r in many.items()}
    for name in ("base_score", "score"):
        assert all(abs(one[i][name] - many[i][name]) < 1e-6 for i in one)


def test_core_words_are_the_most_frequent_ones_of_all(spark, monkeypatch):
    """Words that no block has often, but all together, and buckets that many words share."""
    monkeypatch.setattr(brown, "BUCKETS", 16)
    texts = {i: " ".join([f"a{i} " * 5, *(f"rare{j}" for j in range(i % 7, 300, 7)), "every"]) for i in range(60)}
    docs = documents(spark, texts, extra=False).select(F.col("doc_id").alias("id"), "text", F.lit(False).alias("held")).repartition(20)
    blocks = Scratch(spark).keep(brown.blocks_of(docs, docs.schema["id"].dataType))
    counts = Counter(w for t in texts.values() for w in t.encode().split())
    hashed = {xxhash.xxh3_64_intdigest(w) - (1 << 64) * (xxhash.xxh3_64_intdigest(w) >> 63): n for w, n in counts.items()}
    for core in (1, 40, 100, 1000):
        words, n, _ = brown.frequent_words(blocks, Shape(core=core, core_count=2))
        assert list(zip(words.tolist(), n.tolist(), strict=True)) == sorted(hashed.items(), key=lambda x: (-x[1], x[0]))[:core]


def discount_of(counts):
    """Discounts for counts of one, two and more, by the formula of modified Kneser-Ney smoothing."""
    n = [0, *(sum(c == i for c in counts.values()) for i in (1, 2, 3, 4))]
    if not n[1] or not n[2]:
        d = (0.5, 0.75, 1.0)
    else:
        y = n[1] / (n[1] + 2 * n[2])
        d = tuple(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i) if n[i] else 0.75 for i in (1, 2, 3))
    return lambda c: d[min(c, 3) - 1]


class PlainModel:
    """Trigrams of words, each level interpolated with the one below, whose counts are numbers of kinds in front."""

    def __init__(self, texts):
        tri = Counter(g for t in texts for g in self.grams(t))
        bi = Counter((b, c) for _, b, c in tri)
        uni = Counter(c for _, c in bi)
        self.levels = [{(w,): n for w, n in uni.items()}, dict(bi), dict(tri)]
        self.discounts = [discount_of(level) for level in self.levels]

    @staticmethod
    def grams(text):
        w = ["<s>", "<s>", *(x.decode() for x in words(text, lower=True)), "</s>"]
        return [tuple(w[i - 2 : i + 1]) for i in range(2, len(w))]

    def p(self, gram):
        level, d = self.levels[len(gram) - 1], self.discounts[len(gram) - 1]
        own = {g: n for g, n in level.items() if g[:-1] == gram[:-1]}
        below = self.p(gram[1:]) if len(gram) > 1 else 1 / (len(level) + 1)
        if not own:
            return below
        total = sum(own.values())
        here = own[gram] - d(own[gram]) if gram in own else 0
        return here / total + sum(map(d, own.values())) / total * below

    def perplexity(self, text):
        grams = self.grams(text)
        return 10 ** (-sum(math.log10(self.p(g)) for g in grams) / len(grams))


def test_quality_against_a_plain_version(spark):
    """Every probability by the definition; ties, repeated rows, null ids, languages without trusted rows."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    text = lambda: " ".join(rng.choices(vocabulary, weights=range(30, 0, -1), k=rng.randint(1, 25)))
    rows = [(i, ["en", "de", None][i % 3], text()) for i in range(70)]
    rows += [(100, "en", None), (101, "en", ""), (102, "fr", "never heard words"), (103, "de", "W1 w1\tW2"), (None, "en", "w1 w2 w3"), *rows[:3], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").selectExpr("*", "1 as word", "2 as k", "3 as block")
    labels = spark.createDataFrame([(i, int(i % 5 != 1)) for i in range(70)] + [(2, 0), (None, 1)], "doc_id long, quality int")
    trusted = {i for i in range(70) if i % 5 != 1 and i != 2}
    apart = {r.doc_id for r in docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(5)) == 0).collect()}
    model = PlainModel([t for i, _, t in rows if i in trusted and i not in apart])
    want = {(i, t): model.perplexity(t) if words(t) else None for i, _, t in rows}
    held = [(lang, want[i, t]) for i, lang, t in rows if i in trusted and i in apart and words(t)]
    cut = lambda values: sorted(values)[math.ceil(0.8 * len(values)) - 1]
    threshold = {lang: cut([p for x, p in held if x == lang]) for lang in {x for x, _ in held}}
    got = judge_quality(docs.repartition(3), labels, quantile=0.8).collect()
    assert Counter((r.doc_id, r.lang) for r in got) == Counter((i, lang) for i, lang, _ in rows)
    by = {}
    for i, lang, t in rows:
        by.setdefault(i, (lang, t))
    for r in got:
        lang, t = by[r.doc_id]
        limit = threshold.get(lang, cut([p for _, p in held]))
        assert math.isclose(r.threshold, limit, rel_tol=1e-5)
        if want[r.doc_id, t] is None:
            assert r.perplexity is None and not r.kept
        else:
            assert math.isclose(r.perplexity, want[r.doc_id, t], rel_tol=1e-5)
            assert r.kept == (r.perplexity <= r.threshold)
