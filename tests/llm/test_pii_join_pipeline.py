import contextlib
import hashlib
import io
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from readloom.llm import jaccard_join, pii
from readloom.llm.components import connected
from readloom.llm.jaccard_join import near_duplicates
from readloom.llm.pii import KINDS, find_personal_data, rendered
from readloom.llm.queries import QUERIES
from readloom.llm.rtree import CountTree, as_counts, folded, least_overlap, packed_counts
from readloom.llm.scratch import Scratch

from .helpers import SF, components, documents, sf_texts

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def base(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            passed = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}
            if passed[kind]:
                found.append((m.start(), rank, kind, m.end()))
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def test_pii_against_plain_patterns(spark):
    rng = random.Random(3)
    signs = "0123456789.+-() @ab,_="
    texts = {i: "".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) + rng.choice(["", " é\U0001f600 4111 1111 1111 1111", "x@y.z", "+1 (017) 555-7713 161.17.88.162"]) for i in range(400)}
    texts |= {9000: None, 9001: "", 9002: "1" * 100_000, 9003: "a" * 200_000 + "@", 9004: "1 " * 50_000, 9005: "\x01a@b.c\x02", 9006: "mail a@b.co or c.d@e-f.org."}
    got = {r.doc_id: r for r in find_personal_data(documents(spark, texts)).withColumns({"b": rendered(F.col("base")), "s": rendered(F.col("spans"))}).collect()}
    assert {i: r.b for i, r in got.items()} == {i: ",".join(base(t)) for i, t in texts.items()}
    assert got[9006].redacted == "mail [EMAIL] or [EMAIL]." and got[9000].redacted == got[9001].redacted == ""
    assert all(set(r.b.split(",")) <= {*r.s.split(","), ""} for r in got.values())
    assert find_personal_data(documents(spark, texts).limit(0)).count() == 0


def completed(start, rng):
    """A number of 16 digits that passes the check of cards."""
    digits = start + "".join(rng.choice("0123456789") for _ in range(15 - len(start)))
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def numbers(rng, cards=300, others=300):
    """Cards that start with 4, one in five in groups, and random numbers, alike in all else."""
    grouped = lambda d: "/".join(d[j : j + 4] for j in range(0, 16, 4))
    texts = {i: f"my card {(str if i % 5 else grouped)(completed('4', rng))} is here" for i in range(cards)}
    return texts | {1000 + i: f"my card {rng.choice('56789')}{rng.randrange(10**14, 10**15)} is here" for i in range(others)}


HIDDEN = {9000: "my card 4111/1111/1111/1111 is here", 9001: "my card 4111/1111/1111/1112 is here", 9002: "no card", 9003: "my card 7536/7841/2781/3050 is here", 9004: "4845168114407329 7536784127813050 here"}


def test_pii_trees_decide_on_loose_matches(spark, monkeypatch):
    """Both numbers of 9000 and 9003 pass the check, but only one looks like those that do so more often than by chance."""
    texts = numbers(random.Random(4)) | HIDDEN
    docs = documents(spark, texts)
    told = lambda: {r.doc_id: (rendered_spans(r.base), rendered_spans(r.spans), r.redacted) for r in find_personal_data(docs).collect()}
    got = told()
    assert got[9000] == ([], ["card:8:27"], "my card [CARD] is here")
    assert got[9003] == ([], [], HIDDEN[9003])
    assert got[9004][1] == ["card:0:16"]
    assert got[9001][1] == got[9002][1] == []
    assert all(got[i][0] == base(t) and got[i][1] == (base(t) or ["card:8:27"] * ("/" in t)) for i, t in texts.items() if i < 9000)
    fit = pii.fit_forest
    monkeypatch.setattr(pii, "fit_forest", lambda rows, how: fit(rows, how)._replace(trees=[]))
    assert told()[9000][1] == []


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
def test_pii_has_trees_on_given_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    told = pii.examples(pii.proposed(docs)).groupBy("f", "label", "fold").agg(F.count("*").alias("n")).cache()
    assert {r.label for r in told.select("label").distinct().collect()} == {0, 1}
    assert len(pii.fit_forest(told, pii.Boosting()).trees) > 0


def test_pii_one_more_failure_turns_no_kind_off(spark):
    rows = [([2, 16, 4], 1, 0, 174)] + [([2, 16, 7], 0, 0, 150)] + [([3, 11, 1], 1, 0, 200), ([3, 11, 1], 0, 0, 1)]
    for more in ([], [([2, 16, 4], 0, 0, 1)], [([2, 16, 4], 0, 0, 2)]):
        told = spark.createDataFrame(rows + more, "f array<int>, label int, fold int, n int")
        forest = pii.fit_forest(told, pii.Boosting())
        least = pii.calibrate(told, forest, pii.Boosting())
        margins = {tuple(r.f): r.m for r in told.select("f", pii.margin(forest, F.col("f")).alias("m")).collect()}
        assert margins[2, 16, 7] < least[2] < margins[2, 16, 4] and least[3] <= 0 < margins[3, 11, 1]
    one_kind = spark.createDataFrame(rows[:1], "f array<int>, label int, fold int, n int")
    assert pii.fit_forest(one_kind, pii.Boosting()).trees == []


def test_pii_shares_rise():
    rng = random.Random(2)
    for _ in range(200):
        groups = [(m, rng.randint(0, n), n) for m, n in ((m, rng.randint(1, 9)) for m in range(rng.randint(1, 8)))]
        runs = pii.rising(groups)
        assert [p for _, p in runs] == sorted({p for _, p in runs})
        # the share at a margin is the greatest least mean of a run around it
        for i, (m, _, _) in enumerate(groups):
            mean = lambda a, b: sum(g[1] for g in groups[a:b]) / sum(g[2] for g in groups[a:b])
            want = max(min(mean(a, b) for b in range(i + 1, len(groups) + 1)) for a in range(i + 1))
            assert abs([p for low, p in runs if low <= m][-1] - want) < 1e-12


def test_pii_adds_emails(spark):
    """With examples of both labels, and by the default threshold where a text has no other match."""
    hidden = {9000: "write to jane [at] site [dot] org today", 9001: "write to jane.doe(at)site.example.org today", 9002: "look at site.org today", 9003: "jane [at] site [dot] 77"}
    want = {9000: "write to [EMAIL] today", 9001: "write to [EMAIL] today", 9002: hidden[9002], 9003: hidden[9003]}
    many = {i: f"write to p{i}.q@mail{i % 9}.example.com today" for i in range(600)} | {1000 + i: f"install part{i}@{i % 7}.{i}.2 now" for i in range(300)} | {2000 + i: f"we met at place{i}.com then" for i in range(300)} | {3000 + i: f"ask jo{i} [at] host{i} [dot] net please" for i in range(60)}
    for texts in (hidden, many | hidden):
        got = {r.doc_id: (r.redacted, rendered_spans(r.base)) for r in find_personal_data(documents(spark, texts)).collect()}
        assert {i: got[i] for i in hidden} == {i: (t, []) for i, t in want.items()}
        assert all(got[i][0] == texts[i] for i in texts if 2000 <= i < 3000)


def rendered_spans(spans):
    return [f"{s.kind}:{s.start}:{s.end}" for s in spans]


def test_pii_query(spark):
    texts = sf_texts(spark)
    for r in QUERIES["op3_pii"](spark, SF).collect():
        want = base(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(w.startswith(f"{k}:") for w in want) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= {*r.spans.split(","), ""}


def varied(rng, words, share):
    return [rng.choice("pqrst") + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


def corpus(seed):
    """Copies, near copies of every degree, shared passages, short and empty texts."""
    rng = random.Random(seed)
    texts = []
    passage = [f"s{i}" for i in range(70)]
    for _ in range(25):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 8, 40, 120, 300]))]
        for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05):
            texts.append(" ".join(varied(rng, words, share)))
        texts.append(" ".join(words[: int(len(words) * 0.82)]))
        texts.append(" ".join(words[:60] + passage))
    texts += [" ".join(passage)] * 2 + [" ".join(varied(rng, passage, 0.02)) for _ in range(40)]
    texts += [None, "", "  ", "A b", "a B", "a b c d e", "A b c d e\n", "x"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


def result(spark, texts):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, texts)).collect()}


def test_join_against_all_pairs(spark, monkeypatch):
    for seed, part, sample in ((1, 2048, 10_000), (2, 8, 40)):
        monkeypatch.setattr(jaccard_join, "PART", part)
        monkeypatch.setattr(jaccard_join, "SAMPLE", sample)
        monkeypatch.setattr(jaccard_join, "FEW", part - 8)
        texts = corpus(seed)
        assert result(spark, texts) == components(texts)


def test_join_edges(spark):
    assert near_duplicates(documents(spark, {}).limit(0)).count() == 0
    twice = documents(spark, {5: "a b c d e f", 7: "a b c d e f"}).union(documents(spark, {5: "a b c d e f"}))
    assert sorted(tuple(r) for r in near_duplicates(twice).collect()) == [(5, 2, 5), (5, 2, 5), (7, 2, 5)]
    long = " ".join(f"w{i}" for i in range(60_000))
    assert result(spark, {1: long, 2: long + " more"}) == {1: (59_996, 1), 2: (59_997, 1)}


def kept_tables(monkeypatch):
    """What Scratch writes from now on: columns, rows and explained plan of each table."""
    told, keep = [], Scratch.keep

    def counted(self, df):
        said = io.StringIO()
        with contextlib.redirect_stdout(said):
            df.explain()
        out = keep(self, df)
        told.append((out.columns, out.count(), said.getvalue()))
        return out

    monkeypatch.setattr(Scratch, "keep", counted)
    return told


def alike_texts(n):
    """Texts of 300 words, each with four changes to one base: most pairs share less than 80 percent, but their counts can't tell."""
    rng, texts = random.Random(11), {}
    base = [f"w{i}" for i in range(300)]
    for i in range(n):
        own = list(base)
        for change, at in enumerate(rng.sample(range(5, 290), 4)):
            own[at : at + 2] = [f"x{i}y{change}", f"z{i}y{change}"]
        texts[i] = " ".join(own)
    return texts


def test_join_of_texts_that_hardly_link(spark, monkeypatch):
    """Their pairs within the bound number thousands; no table holds them, and the few links stay."""
    texts = alike_texts(150)
    texts |= {1000 + i: f"{texts[i]} tail" for i in range(0, 150, 10)}
    told = kept_tables(monkeypatch)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, texts)).collect()}
    assert found == components(texts)
    assert len({c for _, c in found.values()}) > 10
    assert max(n for columns, n, _ in told if columns == ["a", "b"]) <= 2 * len(texts)


def test_join_has_short_plans(spark, monkeypatch):
    """Plans within plans, as those of stored tables of stored tables, fill the driver's memory."""
    told = kept_tables(monkeypatch)
    near_duplicates(documents(spark, alike_texts(20))).count()
    assert max(len(plan) for _, _, plan in told) < 20_000
    assert not any("InMemoryTableScan" in plan for _, _, plan in told)


def test_join_query(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op8_jaccard_join"](spark, SF).collect()}
    assert got == components(sf_texts(spark))


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    points = rng.poisson(3, (700, 64))
    points[350:] = np.maximum(points[:350] + rng.integers(-1, 2, (350, 64)) * (rng.random((350, 64)) < 0.1), 0)
    sizes = points.sum(1)
    tree = CountTree(points, sizes, 80)
    for i in range(0, 700, 7):
        bound = np.minimum(points, points[i]).sum(1)
        fit = (100 * sizes >= 80 * sizes[i]) & (80 * sizes <= 100 * sizes[i])
        assert set(tree.search(points[i], sizes[i])) == set(np.flatnonzero(fit & (bound >= least_overlap(sizes[i], sizes, 80))))
    assert as_counts(packed_counts(np.asarray([0, 14, 3, 1]))).tolist() == [0, 14, 3, 1]
    assert as_counts(packed_counts(np.asarray([0, 15]))).tolist() == [14, 14]
    assert folded(np.asarray([1, 2, 3, 4]), 2).tolist() == [4, 6]


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 300), (200, 300), (7, 7)]
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()))
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100} and len(got) == 64
    assert connected(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        by_stage[name] = ({r.doc_id: r.text for r in before.collect()}, {r.doc_id: r["text"] if "text" in docs.columns else None for r in docs.collect()})
    before, after = by_stage["jaccard_join"]
    assert set(after) == {i for i, (_, c) in components(before).items() if i == c}
    before, after = by_stage["pii"]
    assert set(before) == set(after) and not any(base(t) for t in after.values())
    before, after = by_stage["decontamination"]
    bad = {r.doc_id for r in QUERIES["op9_contamination"](spark, SF).collect()}
    assert set(before) - set(after) <= bad and not set(after) & bad
    before, after = by_stage["packing"]
    assert set(before) == set(after)
    run = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in run.select("doc_id").distinct().collect()} == set(after)


LONG = "Some words that make a text of its own, long enough to be kept by every rule there is in the first stage of all."


def test_pipeline_edges(spark):
    """Null ids, repeated rows, different rows of one id, ties, empty and long texts, and columns with clashing names."""
    other = " ".join(f"word{i} of another sentence that is long." for i in range(9))
    rows = [(1, None, "en"), (2, "", None), (3, "A text. " * 3, "en"), (None, LONG, "en"), (None, other, "fr"), (7, LONG + " Truly.", "en"), (8, other, "es"), (9, other, "es"), (9, LONG.upper() + " zzz yyy", "en"), (9, other + " x", "de"), (9, other + " x", "de"), (5, " ".join(f"token{i} flows" for i in range(20_000)), "en")]
    docs = spark.createDataFrame([(*r, "s", 0, "a", 1, "k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, id int, component_id string")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SF)
    assert sorted(((r.doc_id or 0), r.text[:9]) for r in kept.collect()) == sorted(((r[0] or 0), r[1][:9]) for r in rows[3:])
    # The groups: texts with LONG (null, 7; and 9 in capitals), texts with the other sentence (null, 8, 9 and, twice the same row, 9), the long one.
    ones = stages["jaccard_join"](spark, docs, SF)
    assert sorted(((r.doc_id or 0), (r.text or "")[:9]) for r in ones.collect()) == sorted([(1, ""), (2, ""), (3, "A text. A"), (7, LONG[:9]), (8, other[:9]), (5, "token0 fl")])
    for name, stage in stages.items():
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name in ("decontamination", "pii"):
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted((r[0] or 0, r[1] or "") for r in rows)
    pieces = stages["packing"](spark, docs, SF).collect()
    assert sum(r.start == 0 for r in pieces) == len(rows) and {r.doc_id for r in pieces} == {r[0] for r in rows}


def test_quality_stage_against_lines(spark):
    """The first stage keeps what the operator keeps, with the lines that broke no rule."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["quality_rules"](spark, docs, SF).collect()}
    judged = {r.doc_id for r in QUERIES["op10_line_rules"](spark, SF).collect() if r.kept}
    texts = sf_texts(spark)
    assert set(got) == judged
    for i, text in got.items():
        lines = iter(texts[i].split("\n"))
        assert all(line in lines for line in text.split("\n"))  # a subsequence


def test_pii_thresholds_for_all_kinds(spark):
    """Spans of every kind that the base patterns miss, among clean forms that look alike."""
    texts = {1: "ask jo [at] site [dot] org", 2: "server 10[.]0[.]0[.]7 is up", 3: "card 4111-1111.1111-1111 ok", 4: "call (212) 555-0188 now", 5: "server 10[.]0[.]0[.]777 is up", 6: "card 4111-1111.1111-1112 ok", 7: "the years 1914 1918 1939 1945", 8: "look at this.place now"}
    want = {1: "email", 2: "ip", 3: "card", 4: "phone"}
    got = {r.doc_id: (r.base, [s.kind for s in r.spans]) for r in find_personal_data(documents(spark, texts)).collect()}
    assert {i: g[1] for i, g in got.items()} == {i: [want[i]] if i in want else [] for i in texts} and not any(g[0] for g in got.values())
