"""Operator 7: quality by an interpolated modified Kneser-Ney trigram model of trusted text.

A text's log probability is a sum of one value for each of its trigrams, pairs
and words: with interpolation, what a longer n-gram adds to its backoff is a value
of its own. So tokens are dealt by the word before them, with its neighbours: a
group then has all trigrams around a word and needs from others the words'
probabilities only. Groups are made in slices, whose shuffles go before the next
one starts; frequent words are shared by several groups, which get their pairs'
counts. A first round counts, a second one scores. No task holds the tables whole.
Thresholds are quantiles of the perplexity of trusted rows, by language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.arrow import as_bytes, by_bytes, rows
from readloom.llm.jaccard_join import FEW
from readloom.llm.scratch import Scratch
from readloom.llm.shingles import PLACES, mix, rolled

#: Text bytes whose lookups leave a task together; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Bytes of training text whose n-grams are counted together before they leave a task, about.
COUNTED_BYTES = 4 << 20
#: Slices of the groups at most, and text bytes from which on there are more of them. Each slice reads the texts again.
SLICES, SLICE_BYTES = 5, 24 << 20
#: Tokens of a group, about. A word with more than that, as a sample tells, is shared by several groups.
GROUP_TOKENS = 1 << 19
#: Bytes of text of a token, about, and one text of how many tells which words are frequent.
TOKEN_BYTES, SAMPLED = 6, 32
#: Before a text and after it, as hashes of what no word can be.
START, END = b" s", b" e"
#: Bytes of a word's hash.
KEY_BYTES = 7
LOW = np.uint64((1 << 8 * KEY_BYTES) - 1)
#: Longest word in pieces of 8 bytes that is hashed together with others.
PIECES = 8


def hash_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def known_hash(word: bytes) -> int:
    return hash_of(word) & int(LOW)


def hashes_of_words(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the words of ``data``, 8 bytes of all of them at a time. Long ones are hashed one by one."""
    pieces = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    found = mix(sizes.astype(np.uint64))
    at = np.arange(len(starts))
    for i in range(PIECES):
        left = np.minimum(sizes[at] - 8 * i, 8).astype(np.uint64)
        piece = pieces[starts[at] + 8 * i] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        found[at] = mix(found[at] + piece)
        at = at[sizes[at] > 8 * (i + 1)]
        if not len(at):
            break
    for i in at.tolist():
        found[i] = hash_of(data[starts[i] : starts[i] + sizes[i]])
    return found


def padded_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of START twice, the lower-cased words and END of all texts in a row, and how many each text has."""
    data = b"\n".join(texts).lower()
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~blank[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    words = np.diff(np.searchsorted(starts, ends), prepend=0)
    lengths = words + 3
    first = np.cumsum(lengths) - lengths
    out = np.full(lengths.sum(), hash_of(START), np.uint64)
    out[first + lengths - 1] = hash_of(END)
    out[np.arange(len(starts)) + np.repeat(3 * np.arange(len(texts)) + 2, words)] = hashes_of_words(data, starts, sizes)
    return out, lengths


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For each word and each end: hashes of its trigram, of the two words before, of its bigram, of the word before, its own; and its text."""
    if not texts:
        return (*(np.zeros(0, np.uint64) for _ in range(5)), np.zeros(0, np.int64))
    words, lengths = padded_words(texts)
    two, three = rolled(words, 2), rolled(words, 3)
    text = np.repeat(np.arange(len(texts)), lengths)
    at = np.flatnonzero(np.arange(len(words)) - (np.cumsum(lengths) - lengths)[text] >= 2)
    return three[at - 2], two[at - 2], two[at - 1], words[at - 1], words[at], text[at]


def trigrams(docs: DataFrame) -> DataFrame:
    """g3, c2, g2, c1, w, n: the counted trigrams of ``docs`` (id, text)."""
    names = ["g3", "c2", "g2", "c1", "w"]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), COUNTED_BYTES):
            found = grams_of([t for _, t in run])[:5]
            _, at, n = np.unique(found[0], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[at].view(np.int64)) for x in found), pa.array(n)], names=[*names, "n"])

    return docs.select("id", "text").mapInArrow(cut, ", ".join(f"{n} long" for n in [*names, "n"])).groupBy(*names).agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """For counts of one, two and more, from how many n-grams have counts of one to four."""
    return discounts_of(*counts.agg(*(F.count_if(F.col("n") == i) for i in (1, 2, 3, 4))).first())


def discounts_of(n1: int | None, n2: int | None, n3: int | None, n4: int | None) -> tuple[float, float, float]:
    if not n1 or not n2:
        return 0.5, 0.75, 1.0
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(i - (i + 1) * y * b / a, 0.1), float(i)) if a else 0.75 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def taken_by(given: tuple[float, float, float]) -> Column:
    """What is taken from a count n."""
    d1, d2, d3 = given
    return F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)


def discounted(counts: DataFrame, key: str) -> tuple[Column, DataFrame]:
    """What is taken from a count, and for each context its total and the share that was taken."""
    taken = taken_by(discounts(counts))
    return taken, counts.groupBy(key).agg(F.sum("n").alias("total"), (F.sum(taken) / F.sum("n")).alias("left"))


def words_of(uni: DataFrame, given: tuple[float, float, float]) -> tuple[DataFrame, float]:
    """w, p1: probabilities of words from their counts n; and that of a word never seen."""
    taken = taken_by(given)
    total, types, left = uni.agg(F.sum("n"), F.count("*"), F.sum(taken)).first()
    unseen = (left or 1.0) / (total or 1) / (types + 1)
    return uni.select("w", ((F.col("n") - taken) / (total or 1) + unseen).alias("p1")), unseen


def model_of(docs: DataFrame, scratch: Scratch) -> tuple[dict[str, DataFrame], float]:
    """Tables k, v of log10 probabilities and backoff weights by hash, and that of a word never seen."""
    tri = scratch.keep(trigrams(docs))
    bi = scratch.keep(tri.groupBy("g2", "c1", "w").agg(F.count("*").alias("n")))
    uni = scratch.keep(bi.groupBy("w").agg(F.count("*").alias("n")))
    one, unseen = words_of(uni, discounts(uni))
    taken2, before2 = discounted(bi, "c1")
    two = scratch.keep(bi.join(before2, "c1").join(one, "w").select("g2", ((F.col("n") - taken2) / F.col("total") + F.col("left") * F.col("p1")).alias("p2")))
    taken3, before3 = discounted(tri, "c2")
    three = tri.join(before3, "c2").join(two, "g2").select("g3", ((F.col("n") - taken3) / F.col("total") + F.col("left") * F.col("p2")).alias("p3"))

    def table(df: DataFrame, key: str, value: str) -> DataFrame:
        return df.select(F.col(key).alias("k"), F.log10(value).cast("float").alias("v"))

    tables = {"g3": table(three, "g3", "p3"), "c2": table(before3, "c2", "left"), "g2": table(two, "g2", "p2"), "c1": table(before2, "c1", "left"), "w": table(one, "w", "p1")}
    return tables, float(np.log10(unseen))


def in_order(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return keys[order], values[order]


def fit(docs: DataFrame, scratch: Scratch) -> tuple[dict[str, tuple[np.ndarray, np.ndarray]], float]:
    """``model_of`` a few texts, as arrays on the driver."""
    tables, unseen = model_of(docs, scratch)
    found = {name: df.toArrow() for name, df in tables.items()}
    return {name: in_order(t["k"].to_numpy(), t["v"].to_numpy()) for name, t in found.items()}, unseen


class Deal:
    """Which group a token goes to, by the word before it; frequent words are shared by the word before those."""

    def __init__(self, slices: int, groups: int, hot: dict[int, int]):
        self.slices, self.groups = slices, groups
        self.hot = np.asarray(sorted(hot), np.uint64)
        self.shares = np.asarray([hot[h] for h in sorted(hot)], np.uint64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hot & np.uint64(0xFFFF)] = True

    def is_hot(self, words: np.ndarray) -> np.ndarray:
        return np.isin(words, self.hot)

    def least(self, part: int) -> np.uint64:
        """Least order of a part, which may be that of no part."""
        return np.uint64(min(-(-(part << 32) // (self.slices * self.groups)) << 32, (1 << 64) - 1))

    def order(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A number whose first bits are the slice and the group; equal ones have equal ``b``."""
        key = mix(b)
        if len(self.hot):
            hit = np.flatnonzero(self.maybe[b & np.uint64(0xFFFF)])
            at = np.minimum(np.searchsorted(self.hot, b[hit]), len(self.hot) - 1)
            sure = self.hot[at] == b[hit]
            hit, at = hit[sure], at[sure]
            key[hit] = mix(key[hit] + (a[hit] & (self.shares[at] - np.uint64(1))))
        return key

    def part(self, order: np.ndarray) -> np.ndarray:
        """Slice and group as one number."""
        return ((order >> np.uint64(32)) * np.uint64(self.slices * self.groups) >> np.uint64(32)).astype(np.int64)


def narrow_bytes(values: np.ndarray, width: int = 4) -> bytes:
    """Numbers, all first bytes first, so that they pack well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def wide_again(data: bytes, width: int = 4) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((flat.shape[1], 8), np.uint8)
    out[:, :width] = flat.T
    return out.view("<u8").ravel()


TOKENS = "part long, block long, texts binary, runs binary, before binary, middle binary, after binary"


def tokens_of(docs: DataFrame, deal: Deal, first: int, last: int) -> DataFrame:
    """TOKENS: a block's tokens in a group of slices ``first`` to ``last``, runs of them with equal words in the middle; one row without them has the hash and number of tokens of all texts.

    ``docs``: id (a hash of the text), text, usable. Twice the text's number in the block, and one more if it is usable, stands for a text.
    """
    names = [x.split()[0] for x in TOKENS.split(", ")]
    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 5)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flagged = (((h, u), t) for b in batches for h, t, u in zip(b["id"].to_pylist(), as_bytes(b["text"]), b["usable"].to_pylist(), strict=True))
        for i, run in enumerate(by_bytes(flagged, BLOCK_BYTES)):
            block = TaskContext.get().partitionId() << 24 | i
            words, lengths = padded_words([t for _, t in run])
            words &= LOW
            ends = np.cumsum(lengths)
            at = np.ones(len(words), bool)
            at[ends - lengths] = at[ends - lengths + 1] = False
            at = np.flatnonzero(at)
            order = deal.order(words[at - 2], words[at - 1])
            mine = order >= deal.least(first * deal.groups)
            if last + 1 < deal.slices:
                mine &= order < deal.least((last + 1) * deal.groups)
            mine = np.flatnonzero(mine)
            mine = mine[np.argsort(order[mine])]
            order, at = order[mine], at[mine]
            part = deal.part(order)
            text = np.repeat(np.arange(len(run)), lengths)[at]
            stands = 2 * text + np.asarray([u for (_, u), _ in run], np.int64)[text]
            heads = np.flatnonzero(np.diff(order, prepend=order[:1] + np.uint64(1)))
            runs = np.diff(np.append(heads, len(at)))
            cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(at)]
            whole = np.asarray([h for (h, _), _ in run], np.int64).tobytes()
            out = [(first * deal.groups + block % deal.groups, block, whole, narrow_bytes(lengths - 2), None, None, None)]
            for a, b in pairwise(cuts):
                h, k = np.searchsorted(heads, [a, b])
                out.append((int(part[a]), block, narrow_bytes(stands[a:b]), narrow_bytes(runs[h:k]), *(narrow_bytes(words[x], KEY_BYTES) for x in (at[a:b] - 2, at[heads[h:k]] - 1, at[a:b]))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return docs.select("id", "text", "usable").mapInArrow(cut, TOKENS)


def unpacked(row: dict) -> tuple[np.ndarray, ...]:
    """Words two before, before and at each token, and what stands for its text."""
    return wide_again(row["before"], KEY_BYTES), np.repeat(wide_again(row["middle"], KEY_BYTES), wide_again(row["runs"]).astype(np.int64)), wide_again(row["after"], KEY_BYTES), wide_again(row["texts"])


def joined(*words: np.ndarray) -> np.ndarray:
    """Hash of words side by side."""
    return mix(sum((x * p for x, p in zip(words, PLACES, strict=False)), np.full(len(words[0]), len(words), np.uint64)))


def distinct(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted hashes of the distinct trigrams, their three words and counts."""
    g3, at, n = np.unique(joined(a, b, c), return_index=True, return_counts=True)
    return g3, a[at], b[at], c[at], n


COUNTS = "kind int, part long, b long, w long, n long"


def counting(deal: Deal):
    """COUNTS of a group: 0 for each word it needs, with how many words come before it; 1 for pairs of frequent words; 2 and 3 for how many pairs and trigrams have counts of 1 to 4."""

    def count(tokens: pa.Table) -> pa.Table:
        rows_ = [unpacked(r) for r in tokens.to_pylist() if r["before"] is not None]
        out = [[np.zeros(0, np.int64)] * 5]

        def add(kind: int, part: int, b: object, w: np.ndarray, n: np.ndarray) -> None:
            whole = np.ones(len(w), np.int64)
            out.append([kind * whole, part * whole, b * whole, w.astype(np.int64), n.astype(np.int64)])

        if rows_:
            part = int(tokens["part"][0].as_py())
            _, _, b, c, n3 = distinct(*(np.concatenate(x) for x in list(zip(*rows_, strict=True))[:3]))
            _, at, n2 = np.unique(joined(b, c), return_index=True, return_counts=True)
            b, c = b[at], c[at]
            hot = deal.is_hot(b)
            add(1, part, b[hot].astype(np.int64), c[hot], n2[hot])
            needed = np.unique(np.concatenate([b, c]))
            add(0, part, 0, needed, np.bincount(np.searchsorted(needed, c[~hot]), minlength=len(needed)))
            for kind, n in ((2, n2[~hot]), (3, n3)):
                add(kind, part, 0, np.arange(1, 5), np.bincount(np.minimum(n, 5), minlength=5)[1:5])
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table({name: pa.array(x, t) for name, x, t in zip(("kind", "part", "b", "w", "n"), columns, (pa.int32(), *[pa.int64()] * 4), strict=True)})

    return count


def frequent(docs: DataFrame, slices: int) -> dict[int, int]:
    """Words that take more than a group, and how many groups share them (a power of two). Found in a sample; whatever it says, results are the same."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), BLOCK_BYTES):
            found, n = np.unique(padded_words([t for _, t in run])[0] & LOW, return_counts=True)
            often = n * 2000 > n.sum()
            yield pa.RecordBatch.from_arrays([pa.array(found[often].astype(np.int64)), pa.array(n[often])], names=["w", "n"])

    sample = docs.filter(F.pmod("id", F.lit(SAMPLED)) == 0).select("id", "text").mapInArrow(cut, "w long, n long")
    least = GROUP_TOKENS // SAMPLED
    return {r.w: 1 << (r.n // least).bit_length() for r in sample.groupBy("w").agg(F.sum("n").alias("n")).filter(F.col("n") > least).collect()}


def scoring(given2: tuple, given3: tuple, unseen: float, end: float, deal: Deal):
    """block, texts, runs, sums: a group's values, summed by block and text."""
    low, start = np.log10(unseen), known_hash(START)

    def taken(n: np.ndarray, given: tuple) -> np.ndarray:
        return np.asarray(given)[np.minimum(n, 3) - 1]

    def score(tokens: pa.Table, needed: pa.Table) -> pa.Table:
        found = tokens.to_pylist()
        out = [(r["block"], r["texts"], r["runs"], None) for r in found if r["before"] is None]
        found = [r for r in found if r["before"] is not None]
        if found:
            each = [unpacked(r) for r in found]
            a, b, c, stands = (np.concatenate(x) for x in zip(*each, strict=True))
            use = np.flatnonzero(stands & np.uint64(1))
            kind, nb, nw, x, y = (needed[k].to_numpy() for k in ("kind", "b", "w", "x", "y"))
            nb, nw = nb.view(np.uint64), nw.view(np.uint64)
            is_word, is_pair, is_hot = kind == 0, kind == 1, kind == 4
            p1 = in_order(nw[is_word].view(np.int64), x[is_word])
            g3, ua, ub, uc, n3 = distinct(a[use], b[use], c[use])
            c2, which = np.unique(joined(ua, ub), return_inverse=True)
            take3 = taken(n3, given3)
            left3 = np.bincount(which, weights=take3, minlength=len(c2))
            b3 = np.log10(left3 / np.bincount(which, weights=n3, minlength=len(c2)))
            g2, at, pair, n2 = np.unique(joined(ub, uc), return_index=True, return_inverse=True, return_counts=True)
            # Pairs of words that are this group's own; those of frequent words come with their values.
            middle, of = np.unique(ub[at], return_inverse=True)
            take2 = taken(n2, given2)
            left2, total2 = (np.bincount(of, weights=v, minlength=len(middle)) for v in (take2, n2))
            below = looked_up(p1, uc[at], unseen)[0]
            p2 = (n2 - take2 + left2[of] * below) / total2[of]
            d2 = np.log10(1 + (n2 - take2) / (left2[of] * below))
            told, tp, td = (v[is_pair] for v in (nb, x, y))
            told = joined(told, nw[is_pair])
            order = np.argsort(told)
            told, tp, td = told[order], tp[order], td[order]
            hot = np.flatnonzero(deal.is_hot(ub[at]))
            if len(hot):
                p2[hot] = looked_up((told, tp), g2[hot], np.nan)[0]
            d3 = np.log10(1 + (n3 - take3) / (left3[which] * p2[pair]))
            cold, cold_pairs = ~deal.is_hot(middle), ~deal.is_hot(ub[at])
            own = np.where(middle == start, end, looked_up(p1, middle, unseen)[0])
            v1 = in_order(np.concatenate([middle[cold], nb[is_hot]]).view(np.int64), np.concatenate([(np.log10(own) - low + np.log10(left2 / total2))[cold], x[is_hot]]))
            v2 = in_order(np.concatenate([g2[cold_pairs], told]).view(np.int64), np.concatenate([d2[cold_pairs], td]))
            value, hit = looked_up(v1, b, 0.0)
            value = np.where(~hit & (b == start), np.log10(end) - low, value)
            # A known trigram has known pairs, and a known pair a known word in the middle.
            some = np.flatnonzero(hit)
            weight, hit = looked_up((c2, b3), joined(a[some], b[some]), 0.0)
            gain, also = looked_up(v2, joined(b[some], c[some]), 0.0)
            value[some] += weight + gain
            some = some[hit & also]
            value[some] += looked_up((g3, d3), joined(a[some], b[some], c[some]), 0.0)[0]
            cuts = np.cumsum([len(e[0]) for e in each])[:-1]
            for r, text, v in zip(found, np.split((stands >> np.uint64(1)).astype(np.int64), cuts), np.split(value, cuts), strict=True):
                text, of_text = np.unique(text, return_inverse=True)
                out.append((r["block"], narrow_bytes(text), None, np.bincount(of_text, weights=v).tobytes()))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["block", "texts", "runs", "sums"])

    return score


def summed(answers: pa.Table) -> pa.Table:
    """h, n, value: each text's hash, number of tokens and sum over the slice."""
    found = answers.select(["texts", "runs", "sums"]).to_pylist()
    whole = next(r for r in found if r["sums"] is None)
    value = np.zeros(len(whole["texts"]) // 8)
    # In the order of their bytes, so that the sums do not depend on the order of arrival.
    for r in sorted((r for r in found if r["sums"] is not None), key=lambda r: r["sums"]):
        value[wide_again(r["texts"]).astype(np.int64)] += np.frombuffer(r["sums"], np.float64)
    return pa.table({"h": np.frombuffer(whole["texts"], np.int64), "n": wide_again(whole["runs"]).astype(np.int64), "value": value})


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a written table go when it is written, and not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def log10_probabilities(docs: DataFrame, scratch: Scratch, slices: int | None = None, hot: dict[int, int] | None = None) -> DataFrame:
    """h, n, value: hash, number of tokens (words and an end) and log10 probability of each text of ``docs`` (id, its hash; text; usable) in a model of its usable rows."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if slices is None:
        slices = min(SLICES, 1 + size // SLICE_BYTES)
    deal = Deal(slices, 1 + size // TOKEN_BYTES // slices // GROUP_TOKENS, frequent(docs, slices) if hot is None else hot)
    # Usable texts are a part of all; two rounds or less count them.
    half = -(-slices // 2)
    parts = [scratch.keep(tokens_of(docs.filter("usable"), deal, i, i + half - 1).groupBy("part").applyInArrow(counting(deal), COUNTS)) for i in range(0, slices, half)]
    counts = reduce(DataFrame.union, parts)
    pairs = scratch.keep(counts.filter("kind = 1").groupBy("b", "w").agg(F.sum("n").alias("n")))
    seen = {(r.kind, r.w): r.n for r in counts.filter("kind > 1").groupBy("kind", "w").agg(F.sum("n").alias("n")).collect()}
    more = pairs.agg(*(F.count_if(F.col("n") == i) for i in (1, 2, 3, 4))).first()
    given2 = discounts_of(*(seen.get((2, i), 0) + more[i - 1] for i in (1, 2, 3, 4)))
    given3 = discounts_of(*(seen.get((3, i), 0) for i in (1, 2, 3, 4)))
    before = counts.filter("kind = 0").select("w", "n").union(pairs.select("w", F.lit(1).cast("long").alias("n")))
    uni = scratch.keep(before.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 0"))
    one, unseen = words_of(uni, discounts(uni))
    known = one.filter(F.col("w") == known_hash(END)).first()
    end = known["p1"] if known else unseen
    needed = counts.filter("kind = 0").select("part", "w").join(one, "w").select(F.lit(0).alias("kind"), "part", F.lit(0).cast("long").alias("b"), "w", F.col("p1").alias("x"), F.lit(0.0).alias("y"))
    needed = scratch.keep(needed.union(told_of(pairs, one, given2, unseen, end, deal)))
    for part in parts:
        scratch.release(part)
    scores = []
    for own in range(slices):
        mine = needed.filter(F.col("part").between(own * deal.groups, (own + 1) * deal.groups - 1))
        asks = tokens_of(docs, deal, own, own)
        answers = asks.groupBy("part").cogroup(mine.groupBy("part")).applyInArrow(scoring(given2, given3, unseen, end, deal), "block long, texts binary, runs binary, sums binary")
        found = answers.groupBy("block").applyInArrow(summed, "h long, n long, value double")
        scores.append(scratch.keep(found.groupBy("h").agg(F.max("n").alias("n"), F.max("value").alias("value"))))
    return reduce(DataFrame.union, scores).groupBy("h").agg(F.max("n").alias("n"), (F.sum("value") + F.max("n") * float(np.log10(unseen))).alias("value"))


def told_of(pairs: DataFrame, one: DataFrame, given2: tuple, unseen: float, end: float, deal: Deal) -> DataFrame:
    """kind, part, b, w, x, y: for each group that shares a frequent word b, its pairs' probabilities and gains (1), and its own value (4)."""
    n, left, total, taken = F.col("n"), F.col("left"), F.col("total"), taken_by(given2)
    sums = pairs.groupBy("b").agg(F.sum("n").alias("total"), F.sum(taken).alias("left"))
    p1 = F.col("p1")
    each = pairs.join(sums, "b").join(one, "w").select(F.lit(1).alias("kind"), "b", "w", ((n - taken + left * p1) / total).alias("x"), F.log10(1 + (n - taken) / (left * p1)).alias("y"))
    own = F.coalesce(F.when(F.col("b") == known_hash(START), F.lit(end)).otherwise(p1), F.lit(unseen))
    whole = sums.join(one.withColumnRenamed("w", "b"), "b", "left").select(F.lit(4).alias("kind"), "b", F.lit(0).cast("long").alias("w"), (F.log10(own) - float(np.log10(unseen)) + F.log10(left / total)).alias("x"), F.lit(0.0).alias("y"))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = dict(zip(deal.hot.tolist(), deal.shares.tolist(), strict=True))
        for batch in batches:
            b = batch["b"].to_numpy().view(np.uint64)
            times = np.asarray([shares[x] for x in b.tolist()], np.int64)
            row = np.repeat(np.arange(len(b)), times)
            share = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            part = deal.part(deal.order(share.astype(np.uint64), b[row]))
            # A group may have several shares of a word.
            _, at = np.unique(np.stack([row, part]), axis=1, return_index=True)
            yield pa.RecordBatch.from_arrays([batch["kind"].take(pa.array(row[at])), pa.array(part[at]), *(batch[c].take(pa.array(row[at])) for c in ("b", "w", "x", "y"))], names=["kind", "part", "b", "w", "x", "y"])

    return each.union(whole).mapInArrow(spread, "kind int, part long, b long, w long, x double, y double")


def looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, otherwise: float) -> tuple[np.ndarray, np.ndarray]:
    """Values of the keys, and which keys the table has."""
    known, values = table
    if not len(known):
        return np.full(len(keys), otherwise), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return np.where(hit, values[at], otherwise), hit


def log_probability(tables: dict[str, tuple[np.ndarray, np.ndarray]], unseen: float, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability and number of tokens (words and an end) of each text."""
    g3, c2, g2, c1, w, text = grams_of(texts)
    value, hit = looked_up(tables["g3"], g3, 0.0)
    miss = np.flatnonzero(~hit)
    value[miss], _ = looked_up(tables["c2"], c2[miss], 0.0)
    below, hit = looked_up(tables["g2"], g2[miss], 0.0)
    value[miss] += below
    last = miss[~hit]
    value[last] += looked_up(tables["c1"], c1[last], 0.0)[0] + looked_up(tables["w"], w[last], unseen)[0]
    return np.bincount(text, weights=value, minlength=len(texts)), np.bincount(text, minlength=len(texts))


def judge_quality(docs: DataFrame, labels: DataFrame, *, quantile: float = 0.995, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """``id_col``, ``lang_col``, n_tokens, perplexity, threshold and kept of every row.

    Trusted rows are those that ``labels`` gives a ``label_col`` of 1 (and none
    of 0). The model learns from four fifths of them, chosen by a
    hash of the id; a language's threshold is the
    ``quantile`` of all of the other fifth, and a language without such rows has
    that of all languages. A row is kept if its perplexity is not over the
    threshold; without any trusted row all are. A null or empty text has a null perplexity and is not
    kept. Repeated rows give repeated results; a null id has no label; null
    languages are one language; empty tables are fine.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    trusted = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).groupBy("id").agg(F.min("label").alias("label")).filter("label = 1").select("id", F.lit(True).alias("trusted"))
    trusted = scratch.keep(trusted)
    few = F.broadcast(trusted) if trusted.count() <= FEW else trusted
    apart = F.pmod(F.xxhash64("id", F.lit("apart")), F.lit(5)) == 0
    usable = F.coalesce("trusted", F.lit(False)) & F.coalesce(~apart, F.lit(False))
    texts = narrow.join(few, "id", "left").select(F.xxhash64("text").alias("id"), "text", usable.alias("usable"))
    with shuffles_removed(spark):
        scores = log10_probabilities(texts, scratch)
        perplexity = F.when(F.col("n") > 1, F.pow(F.lit(10.0), F.least(-F.col("value") / F.col("n"), F.lit(300.0))))
        found = scratch.keep(narrow.select("id", "lang", F.xxhash64("text").alias("h")).join(scores, "h").select("id", "lang", F.col("n").alias("n_tokens"), perplexity.alias("perplexity")))
    kept_apart = found.filter(apart & F.col("perplexity").isNotNull()).join(few.select("id"), "id", "left_semi")
    at = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = kept_apart.groupBy(F.coalesce("lang", F.lit("")).alias("key")).agg(at.alias("own"))
    overall = kept_apart.agg(at.alias("q")).first()[0]
    joined = found.withColumn("key", F.coalesce("lang", F.lit(""))).join(by_lang, "key", "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"), F.lit(float("inf")))
    return joined.select(F.col("id").alias(id_col), F.col("lang").alias(lang_col), "n_tokens", "perplexity", threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("kept"))
