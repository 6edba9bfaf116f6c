import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from readloom.llm import divergence
from readloom.llm.divergence import both_ways, chances, gallop, occurrences, source_divergence
from readloom.llm.queries import QUERIES
from readloom.llm.sharding import blocks_of, hypergeometric, matrix_row, shuffle_into_shards, stream
from readloom.llm.vector_codes import Shape, assigned, compress_vectors, digest, grouped, moved, with_label_error

from .helpers import CLASHING, SF, documents


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Every distance of every round."""
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts if kept else 0
    least = {}
    for i, _, v in kept:
        if i is not None:
            least[i] = min(v, least.get(i, v))
    first = [least[i] for i in sorted(least)][:entries]
    books = [[v[p * width : (p + 1) * width] for v in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for _, _, v in kept:
                own[nearest(p, v[p * width : (p + 1) * width])[1]].append(v[p * width : (p + 1) * width])
            for e, xs in own.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for i, label, v in kept:
        found = [nearest(p, v[p * width : (p + 1) * width]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    sums = Counter()
    for _, label, _, error in out:
        sums[label] += error
    said = ",".join(str(c) for book in books for y in book for c in y)
    return sorted(((i, code, error, sums[label]) for i, label, code, error in out), key=str), hashlib.sha256(said.encode()).hexdigest()


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return df.selectExpr("*", *(f"cast(7 as {kind}) as {name}" for name, kind in (c.split() for c in CLASHING.split(", ")) if name != "label"), "1 as v", "'x' as codes", "0 as of_label")


def test_codes_equal_all_distances(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(0, 3)), rng.normal(0, 0.02, 32).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, None, rows[i][2]) for i in range(20)] + rows[:5] * 2 + [(3, 1, rows[9][2]), (None, 1, rows[8][2])]
    odd = [(300, 1, None), (301, 1, []), (302, 1, [None] * 32), (303, 1, [float("nan")] * 32), (304, None, [float("inf")] + [0.0] * 31)]
    coded, books = compress_vectors(vectors(spark, rows + odd))
    want, said = plain_codes(rows + odd)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in with_label_error(coded).collect()), key=str)
    assert got == want
    assert digest(books) == said


@pytest.mark.parametrize("rows", [[], [(1, 1, None)], [(5, None, [0.5] * 16), (4, 2, [-0.001] * 16)]])
def test_codes_of_few_vectors(spark, rows):
    coded, books = compress_vectors(vectors(spark, rows))
    want, said = plain_codes(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in with_label_error(coded).collect()), key=str) == want
    assert not rows[1:] or digest(books) == said


@pytest.mark.parametrize("rows", [[(1, 1, [0.0] * 16), (2, 1, [0.0] * 32)], [(1, 1, [0.0] * 20)], [(1, 1, [1e30] * 16)]])
def test_codes_say_what_they_cannot_do(spark, rows):
    with pytest.raises(Exception, match="one length|must be below"):
        compress_vectors(vectors(spark, rows))[0].collect()


def test_net_moves_are_shorter_and_bounds_save_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(-60, 60, (4000, 4))
    books = [x[:64].copy()]
    members = grouped(books[0], 4)
    assert sorted(np.concatenate(members).tolist()) == list(range(64))
    codes, bounds, stamps = np.zeros(4000, np.int64), np.zeros((4000, 4), np.float16), np.zeros((4000, 4), np.uint8)
    spent = []
    for _ in range(12):
        codes, best, measured = assigned(x, books, members, codes, bounds, stamps)
        d = ((x[:, None] - books[-1][None]) ** 2).sum(2)
        assert (codes == d.argmin(1)).all() and (best == d.min(1)).all()
        for g, own in enumerate(members):
            # every bound holds for the codebook of its round
            then = np.stack([((x - books[s][e]) ** 2).sum(1) for s in range(len(books)) for e in own]).reshape(len(books), len(own), -1)
            there = np.where(own[None, :, None] == codes[None, None], np.inf, then).min(axis=1)[stamps[:, g], np.arange(4000)]
            assert (bounds[:, g].astype(float) <= np.sqrt(there) * (1 + 1e-9)).all()
        spent.append(measured)
        after = books[-1].copy()
        for e in np.unique(codes):
            after[e] = x[codes == e].sum(0) // (codes == e).sum()
        books.append(after)
    assert spent[0] >= 4000 * 64 and spent[-1] < spent[0] / 3
    net = moved(books, members)
    steps = np.stack([np.sqrt(((b - a) ** 2).sum(1)) for a, b in zip(books, books[1:], strict=False)])
    drift = np.stack([steps[s:].sum(0) for s in range(len(books))])
    assert all((net[g] <= drift[:, own].max(1) + 1e-9).all() for g, own in enumerate(members))
    assert net.sum() < 0.9 * sum(drift[:, own].max(1).sum() for own in members)


def test_vector_codes_query(spark):
    got = QUERIES["op11_vector_codes"](spark, SF).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    want, said = plain_codes(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == want
    assert {r.codebooks_sha256 for r in got} == {said}


def laid(df):
    return [(r.shard, r.slot) for r in df.select("shard", "slot").collect()]


def exact(places, rows, shards=8):
    held = defaultdict(list)
    for shard, slot in places:
        held[shard].append(slot)
    sizes = [rows // shards + (s < rows % shards) for s in range(shards)]
    return all(sorted(held[s]) == list(range(sizes[s])) for s in range(shards)) and set(held) <= set(range(shards))


@pytest.mark.parametrize("rows", [0, 1, 7, 8, 1003])
def test_shards_are_exact(spark, rows):
    docs = documents(spark, {i: ["same", None, "", f"text {i}"][i % 4] for i in range(rows)}).repartition(5)
    docs = docs.selectExpr("*", "1 as shard", "2 as slot", "4 as sharding")
    dealt = shuffle_into_shards(docs, block_rows=20)
    assert exact(laid(dealt), rows)
    assert sorted(r.doc_id for r in dealt.collect()) == list(range(rows))
    assert Counter(r.text for r in dealt.collect()) == Counter(r.text for r in docs.collect())


def test_repeated_and_null_rows_are_sharded(spark):
    docs = spark.createDataFrame([(1, "a")] * 40 + [(None, None)] * 9 + [(2, "long " * 200_000)], "doc_id long, text string")
    dealt = shuffle_into_shards(docs, shards=3)
    assert exact(laid(dealt), 50, 3)
    assert Counter(r.doc_id for r in dealt.collect()) == {1: 40, None: 9, 2: 1}


def test_shards_query(spark):
    got = QUERIES["op12_sharding"](spark, SF).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    assert exact([(r.shard, r.slot) for r in got], len(texts)) and {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_the_order_follows_from_the_seed_and_is_not_the_old_one(spark):
    docs = spark.range(2000).withColumnRenamed("id", "doc_id").repartition(4)
    order = lambda seed: [r.doc_id for r in sorted(shuffle_into_shards(docs, seed=seed, block_rows=100).collect(), key=lambda r: (r.shard, r.slot))]
    first = order(1)
    assert first == order(1) != order(2)
    assert abs(np.corrcoef(first, range(2000))[0, 1]) < 0.1


def test_all_orders_are_alike(spark):
    """Four rows of two partitions in two shards: each of the 24 orders comes about as often."""
    docs = spark.createDataFrame([(i,) for i in range(4)], "doc_id long").repartitionByRange(2, "doc_id")
    before, (_, _, columns) = np.asarray([0, 2, 4]), blocks_of(4, 2, 10, 10)
    seen = Counter(tuple(matrix_row(seed, before, columns, 0).tolist()) for seed in range(3000))
    assert all(abs(seen[k] / 3000 - p) < 0.04 for k, p in {(2, 0): 1 / 6, (1, 1): 2 / 3, (0, 2): 1 / 6}.items())
    assert exact(laid(shuffle_into_shards(docs, shards=2)), 4, 2)


def test_matrix_rows_and_columns_add_up():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 400, 37)
    before = np.concatenate([[0], np.cumsum(sizes)])
    _, first, columns = blocks_of(int(before[-1]), 8, 300, 1000)
    matrix = np.stack([matrix_row(4, before, columns, i) for i in range(37)])
    assert (matrix.sum(1) == sizes).all() and (matrix.sum(0) == columns).all() and (matrix >= 0).all()
    assert columns.max() <= 300 and (first >= 0).all()


def test_draws_beyond_numpy_follow_the_same_law(monkeypatch):
    from readloom.llm import sharding

    monkeypatch.setattr(sharding, "NUMPY_ROWS", 0)
    draws = np.asarray([hypergeometric(stream(1, 9, i), 30, 50, 25) for i in range(4000)])
    weight = np.asarray([math.comb(30, k) * math.comb(50, 25 - k) / math.comb(80, 25) for k in range(26)])
    told = np.bincount(draws, minlength=26) / 4000
    assert np.abs(np.cumsum(told) - np.cumsum(weight)).max() < 0.03
    for good, bad, drawn, want in ((0, 5, 3, 0), (5, 0, 3, 3), (3, 4, 7, 3), (3, 4, 0, 0), (1, 0, 1, 1)):
        assert hypergeometric(stream(1, 2), good, bad, drawn) == want
    huge = np.asarray([hypergeometric(stream(2, 9, i), 6 * 10**9, 44 * 10**9, 25 * 10**9) for i in range(30)])
    sd = math.sqrt(25e9 * 0.12 * 0.88 * 0.5)
    assert abs(huge.mean() - 3e9) < sd and 0.5 * sd < huge.std() < 1.6 * sd
    _, _, columns = blocks_of(5 * 10**9, 8, 10_000, 64)
    row = matrix_row(1, np.arange(5) * (5 * 10**9 // 4), columns, 3)
    assert row.sum() == 5 * 10**9 // 4 and (row > 0).all()


def plain_divergence(rows, holders=3, most=200):
    """By the definition, term by term."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = lambda t: "".join(c.lower() if c < "\x80" else c for c in t)
    docs = [(lang or "", source or "", Counter(term.findall(lower(text or "")))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, c) for x, s, c in docs if x == lang]
        have = Counter(t for _, c in own for t in c)
        kept = {t for t in have if have[t] >= holders}
        groups = defaultdict(Counter)
        for s, c in own:
            groups[s].update({t: n for t, n in c.items() if t in kept})
        whole = sum(groups.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) ** 2 // b
        for s, c in groups.items():
            pairs = sorted((-sum(f(p(c, t), p(o, t)) for t in kept), x.encode(), x) for x, o in groups.items() if x != s)
            terms = sorted((-f(p(c, t), p(whole, t)), t.encode(), t) for t in kept if c[t] and p(c, t) > p(whole, t))
            out += [(lang, s, "pair", x, -v, i + 1) for i, (v, _, x) in enumerate(pairs)]
            out += [(lang, s, "term", x, -v, i + 1) for i, (v, _, x) in enumerate(terms[:most])]
    return sorted(out)


GROUPS = [
    ("The cat, the DOG & the bird_bird", "en", "a"),
    ("the dog saw a cat; É é ÉÉ", "en", "a"),
    ("the dog the dog é naïve ÉÉ", "en", "b"),
    ("dog é naïve the naïve", "en", "c"),
    (None, "en", "d"),
    ("", "en", None),
    ("x1x2x x x", None, "a"),
    ("x y", None, "b"),
    ("only once", "fr", "a"),
    ("never more", "fr", "b"),
    ("alone alone alone", "de", "a"),
    ("dog é cat\x7fcat 汉字 汉字", "en", "b"),
    ("汉字 dog", "en", "b"),
    ("汉字 dog", "en", "b"),
    ("dog " * 3000 + "汉字", "en", "c"),
]


@pytest.mark.parametrize("block_terms", [1, 3, 32_768])
def test_divergence_equals_the_definition(spark, monkeypatch, block_terms):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block_terms)
    docs = spark.createDataFrame(GROUPS, "text string, lang string, source string").selectExpr("*", "1 as term", "2 as n", "3 as block", "'x' as a", "4 as rank").repartition(3)
    got = sorted(tuple(r) for r in source_divergence(docs, most_terms=4).collect())
    assert got == plain_divergence(GROUPS, most=4)


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert source_divergence(docs).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 900)), st.sets(st.integers(0, 900)))
def test_gallop_finds_what_both_have(a, b):
    few, many = (np.asarray(sorted(x), np.int64) for x in sorted((a, b), key=len))
    x, y = gallop(few, many)
    assert few[x].tolist() == many[y].tolist() == sorted(a & b)


def test_gallop_over_long_arrays():
    many = np.arange(0, 900_000, 3)
    few = np.asarray([*range(5, 700_000, 977), 899_997])
    x, _ = gallop(few, many)
    assert few[x].tolist() == [n for n in few.tolist() if n % 3 == 0]


def test_chances_are_exact_for_great_counts():
    counts = [0, 1, 7, 10**12, 10**13 - 1]
    total = 10**13 + 7
    assert chances(np.asarray(counts), total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]


def test_prices_do_not_depend_on_which_array_is_longer():
    a, b = (np.asarray([1, 2, 9]), np.asarray([5, 1, 2])), (np.asarray([2]), np.asarray([4]))
    there, back, held = both_ways(a, b, 20, 15)
    assert (back, there, held) == both_ways(b, a, 15, 20)
    assert held == 3


def test_long_texts_are_counted_in_slices(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 5)
    text = "aa bbbbbbbbbbbbbbbb,cc Éé dd aa".encode()
    assert occurrences(text) == Counter({b"aa": 2, b"bbbbbbbbbbbbbbbb": 1, b"cc": 1, "Éé".encode(): 1, b"dd": 1})
