"""Operator 1: language-model scores by Brown class bigrams.

Texts become blocks of local word numbers, kept in the shared folder. Exchange
clustering moves words between classes while that raises the likelihood of the
class bigrams. It goes in rounds for the most frequent words, whose contexts fit
the driver's bounds; then every other word of the training texts is exchanged,
given the classes of its neighbours, where its counts from all blocks meet, and
its class and count go back to the blocks. Words that no training text has take
the class that frequent words with their ending mostly have. A word's probability
is its class's after the previous class, times the word's within its class, with
a share of each class for unknown words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from readloom.llm.arrow import as_bytes, by_bytes
from readloom.llm.scratch import Scratch
from readloom.llm.tokens import arrow_type

#: Text bytes of a block; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
#: Endings have up to so many bytes.
ENDING = 3
#: Buckets of words, a power of two, that are counted to leave rare words out.
BUCKETS = 1 << 18
#: Bits of a count in a packed context; greater counts take several.
COUNT_BITS = 20


class Shape(NamedTuple):
    """Parameters: words that are exchanged in rounds (the others once, at the end), and how often a block must have a word for a first guess at their least count; classes; rounds; by how much a class of other words must raise the log-likelihood, so that few contexts don't outweigh an ending."""

    core: int = 8192
    core_count: int = 4
    classes: int = 64
    rounds: int = 8
    gain: float = 3.0


def packed(tokens: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(tokens.astype("<u4").tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<u4")


def one_list(values, kind: pa.DataType) -> pa.Array:
    """A column of one row with a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def blocks_of(docs: DataFrame, id_type: DataType) -> DataFrame:
    """One row per block: its distinct words (hash, training count, ending) and its texts as word numbers.

    Number 0 is the end of a text, which no word equals. ``docs``: id, text, held.
    """
    arrow_id = arrow_type(docs, "id")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        triples = ((i, h, t) for b in batches for i, h, t in zip(b["id"].to_pylist(), b["held"].to_pylist(), as_bytes(b["text"]), strict=True))
        for run in by_bytes((((i, h), t) for i, h, t in triples), BLOCK_BYTES):
            place: dict[bytes, int] = {b"": 0}
            texts = []
            for _, text in run:
                words = text.lower().split()
                words.append(b"")
                for w in set(words).difference(place):
                    place[w] = len(place)
                texts.append(np.fromiter(map(place.__getitem__, words), np.uint32, len(words)))
            flat_ = np.concatenate(texts)
            held = np.asarray([h for (_, h), _ in run])
            sizes = np.asarray([len(t) for t in texts], np.int32)
            counts = np.bincount(flat_[~np.repeat(held, sizes)], minlength=len(place))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place)).view(np.int64)
            endings = np.fromiter((int.from_bytes(w[-ENDING:], "little") for w in place), np.int32, len(place))
            lists = [one_list(hashes, pa.int64()), one_list(counts.astype(np.int32), pa.int32()), one_list(endings, pa.int32()), pa.array([packed(flat_)], pa.binary()), one_list([i for (i, _), _ in run], arrow_id), one_list(held, pa.bool_()), one_list(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists], names=["block", "words", "counts", "endings", "tokens", "ids", "held", "sizes"])
            block += 1

    return docs.mapInArrow(cut, f"block long, words array<long>, counts array<int>, endings array<int>, tokens binary, ids array<{id_type.simpleString()}>, held array<boolean>, sizes array<int>")


def flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def word_sums(blocks: DataFrame, chosen) -> DataFrame:
    """word, n, ending: training counts of the words that ``chosen`` (hashes, counts in the block) picks, summed over the blocks that propose them."""

    def proposed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words, counts, endings = (flat(b[c].slice(i, 1)) for c in ("words", "counts", "endings"))
                own = np.flatnonzero((counts > 0) & chosen(words, counts) & (np.arange(len(words)) > 0))
                yield pa.RecordBatch.from_arrays([pa.array(words[own]), pa.array(counts[own].astype(np.int64)), pa.array(endings[own])], names=["word", "n", "ending"])

    return blocks.select("words", "counts", "endings").mapInArrow(proposed, "word long, n long, ending int").groupBy("word").agg(F.sum("n").alias("n"), F.min("ending").alias("ending"))


def full_buckets(blocks: DataFrame, least: int) -> np.ndarray:
    """Which of BUCKETS buckets of words have ``least`` occurrences together."""
    buckets = BUCKETS

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                sums += np.bincount(flat(b["words"].slice(i, 1)) & (buckets - 1), flat(b["counts"].slice(i, 1)), buckets).astype(np.int64)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(sums[there])], names=["bucket", "n"])

    full = np.zeros(buckets, bool)
    sums = blocks.select("words", "counts").mapInArrow(summed, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    full[sums.filter(F.col("n") >= least).select("bucket").toPandas()["bucket"].to_numpy(np.int64)] = True
    return full


def frequent_words(blocks: DataFrame, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, counts and endings of the ``shape.core`` most frequent words of all blocks, of equals those with lesser hashes.

    Words that are frequent within blocks give a count that so many words reach at
    least. Words in buckets that don't reach it together can't be among the most
    frequent ones; all others are counted in full, so blocks don't change the result.
    """
    often = word_sums(blocks, lambda words, counts: counts >= shape.core_count).orderBy(F.desc("n")).limit(shape.core).agg(F.count("*"), F.min("n")).first()
    least = int(often[1] or 1) if often[0] == shape.core else 1
    full = full_buckets(blocks, least)
    top = word_sums(blocks, lambda words, counts: full[words & (len(full) - 1)]).orderBy(F.desc("n"), "word").limit(shape.core).toPandas()
    return tuple(top[c].to_numpy(np.int64) for c in ("word", "n", "ending"))


class Classes:
    """Which class a word has before the last exchange: by its hash if it is a core word, otherwise by its ending."""

    def __init__(self, words: np.ndarray, endings: np.ndarray, counts: np.ndarray, classes: np.ndarray, number: int):
        order = np.argsort(words)
        self.words, self.classes, self.number = words[order], classes[order], number
        self.by_ending: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in range(ENDING, -1, -1):
            key = self.ending(endings, size)
            kinds, at = np.unique(key, return_inverse=True)
            votes = np.zeros((len(kinds), number))
            np.add.at(votes, (at, classes), counts)
            self.by_ending[size] = kinds, votes.argmax(1)

    @staticmethod
    def ending(endings: np.ndarray, size: int) -> np.ndarray:
        """The last ``size`` bytes of stored endings."""
        lengths = np.where(endings >= 1 << 16, 3, np.where(endings >= 1 << 8, 2, 1))
        return endings >> (8 * np.maximum(lengths - size, 0)) if size else np.zeros_like(endings)

    def core(self, words: np.ndarray) -> np.ndarray:
        """Which words are core words."""
        if not len(self.words):
            return np.zeros(len(words), bool)
        return self.words[np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)] == words

    def of(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        if not len(self.words):
            return out
        for size in range(0, ENDING + 1):
            kinds, classes = self.by_ending[size]
            key = self.ending(endings, size)
            at = np.minimum(np.searchsorted(kinds, key), len(kinds) - 1)
            hit = kinds[at] == key
            out[hit] = classes[at[hit]]
        hit = self.core(words)
        out[hit] = self.classes[np.searchsorted(self.words, words[hit])]
        return out


def training_pairs(tokens: np.ndarray, held: np.ndarray, sizes: np.ndarray, classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the previous and of the present token, for all training tokens of a block; a text starts after an end."""
    now = classes[tokens]
    before = np.concatenate([[end], now[:-1]])
    keep = ~np.repeat(held, sizes)
    return before[keep], now[keep]


def summed_pairs(blocks: DataFrame, value_of, base: int, end: int, *, skip: int | None = None) -> DataFrame:
    """code = previous * base + present, n: pairs of values over all training tokens; pairs with ``skip`` are left out."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                values = value_of(flat(b["words"].slice(i, 1)), flat(b["endings"].slice(i, 1)))
                values[0] = end
                before, now = training_pairs(unpacked(b["tokens"][i].as_py()), flat(b["held"].slice(i, 1)), flat(b["sizes"].slice(i, 1)), values, end)
                if skip is not None:
                    known = (before != skip) & (now != skip)
                    before, now = before[known], now[known]
                codes, n = np.unique(before * base + now, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

    rows = blocks.select("words", "endings", "tokens", "held", "sizes").mapInArrow(counted, "code long, n long")
    return rows.groupBy("code").agg(F.sum("n").alias("n"))


class Gains:
    """How likely a word's contexts are under each class, from the class bigrams (their counts in ``grid``)."""

    def __init__(self, grid: np.ndarray):
        smooth = grid + 0.5
        self.after = np.log(smooth / smooth.sum(1, keepdims=True))  # of the next class
        self.total = np.log(smooth.sum(0))

    def best(self, contexts: np.ndarray, number: int, own: np.ndarray | None = None, least: float = 0.0) -> np.ndarray:
        """The best of the first ``number`` classes for each row (counts of the next classes, then of those before), or its own if none gains ``least`` over that."""
        right, left = np.split(contexts, 2, axis=1)
        gain = right @ self.after.T + left @ self.after - left.sum(1, keepdims=True) * self.total
        if own is not None:
            gain[np.arange(len(gain)), own] += least
        return np.round(gain[:, :number], 6).argmax(1)  # so that the order of sums decides nothing


def exchanged(pairs: DataFrame, core: int, number: int, rounds: int) -> np.ndarray:
    """Class of each core word (numbers 0 to core - 1; the end of a text is number core and keeps a class of its own).

    ``pairs``: code = previous * (core + 1) + present, n. Each round sums the
    class bigrams, then gives half of the words, in turn, the class under which
    their contexts are likeliest. Words of a half move at once, so the likelihood of
    a round may fall; the classes of the likeliest round are returned. Only counts
    by class and the class of each core word, both bounded by parameters, reach the driver.
    """
    base, all_classes = core + 1, number + 1
    classes = np.arange(base) % number
    classes[core] = number
    session = pairs.sparkSession
    turned = pairs.select(F.floor(F.col("code") / base).cast("int").alias("a"), F.pmod("code", F.lit(base)).cast("int").alias("b"), "n")
    both = turned.select(F.col("a").alias("word"), F.col("b").alias("near"), F.lit(0).alias("side"), "n").union(turned.select(F.col("b"), F.col("a"), F.lit(1), "n"))
    scratch = Scratch(session)
    laid = scratch.keep(both.repartition("word").sortWithinPartitions("word"))
    likeliest, best = classes.copy(), -np.inf

    def by_class(now: np.ndarray) -> DataFrame:
        def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                word, near, side, n = (b[c].to_numpy() for c in ("word", "near", "side", "n"))
                key = word.astype(np.int64) * (2 * all_classes) + side * all_classes + now[near]
                codes, at = np.unique(key, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes // (2 * all_classes), pa.int64()), pa.array(codes % (2 * all_classes), pa.int64()), pa.array(np.bincount(at, weights=n).astype(np.int64))], names=["word", "context", "n"])

        return laid.mapInArrow(summed, "word long, context long, n long").groupBy("word", "context").agg(F.sum("n").alias("n"))

    for turn in range(rounds + 1):
        contexts = scratch.keep(by_class(classes))
        grid = np.zeros((all_classes, all_classes))
        for r in class_sums(contexts, classes, all_classes):
            grid[r["own"], r["context"]] += r["n"]
        reached = class_likelihood(grid)
        if reached > best:
            likeliest, best = classes.copy(), reached
        if turn == rounds:
            break
        gains = Gains(grid)

        def choose(batches: Iterable[pa.RecordBatch], gains=gains, turn=turn) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for b in batches:
                for w, c, n in zip(*(b[x].to_pylist() for x in ("word", "context", "n")), strict=True):
                    if w < core and w % 2 == turn % 2:
                        held.setdefault(w, np.zeros(2 * all_classes))[c] += n
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(gains.best(np.stack(list(held.values())), number), pa.int64())], names=["word", "class"])

        moved = contexts.repartition("word").mapInArrow(choose, "word long, class long").toPandas()
        classes[moved["word"].to_numpy(np.int64)] = moved["class"].to_numpy(np.int64)
    return likeliest[:core]


def class_likelihood(grid: np.ndarray) -> float:
    """The part of the training likelihood that classes change: of class bigrams, less that of the classes themselves."""
    one = lambda n: float((n[n > 0] * np.log(n[n > 0])).sum())
    return one(grid) - one(grid.sum(0)) - one(grid.sum(1))


def class_sums(contexts: DataFrame, classes: np.ndarray, number: int) -> list:
    """Class bigrams from the words' context counts."""

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros(number * number, np.int64)
        for b in batches:
            word, context, n = (b[c].to_numpy() for c in ("word", "context", "n"))
            right = context < number
            np.add.at(grid, classes[word[right]] * number + context[right], n[right])
        there = np.flatnonzero(grid)
        yield pa.RecordBatch.from_arrays([pa.array(there // number), pa.array(there % number), pa.array(grid[there])], names=["own", "context", "n"])

    return contexts.mapInArrow(summed, "own long, context long, n long").groupBy("own", "context").agg(F.sum("n").alias("n")).collect()


def packed_contexts(before: np.ndarray, now: np.ndarray, before_class: np.ndarray, now_class: np.ndarray, words: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each local word its contexts as 32-bit numbers in a row (which one, then how often), and where each word's start."""
    keys = np.concatenate([before.astype(np.int64) * (2 * classes) + now_class, now.astype(np.int64) * (2 * classes) + classes + before_class])
    keys, n = np.unique(keys, return_counts=True)
    most = (1 << COUNT_BITS) - 1
    times = -(-n // most)
    keys, n, times = np.repeat(keys, times), np.repeat(n, times), np.repeat(times, times)
    first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    share = np.where(first, n - (times - 1) * most, most)
    codes = ((keys % (2 * classes)) << COUNT_BITS | share).astype("<u4")
    return codes, np.searchsorted(keys // (2 * classes), np.arange(words + 1))


def messages(blocks: DataFrame, model: Classes, number: int) -> DataFrame:
    """block, place, word, n, own, contexts: what each block tells of its words but the core ones, the class they have now among it."""

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words, counts, endings = (flat(b[c].slice(i, 1)) for c in ("words", "counts", "endings"))
                own = model.of(words, endings)
                own[0] = number
                tokens, keep = unpacked(b["tokens"][i].as_py()), ~np.repeat(flat(b["held"].slice(i, 1)), flat(b["sizes"].slice(i, 1)))
                before, now = np.concatenate([[0], tokens[:-1]])[keep], tokens[keep]
                codes, starts = packed_contexts(before, now, own[before], own[now], len(words), number + 1)
                others = np.flatnonzero(~model.core(words))
                others = others[others > 0]
                for s in range(0, len(others), 1 << 15):
                    at = others[s : s + (1 << 15)]
                    lists = [codes[x:y].tobytes() for x, y in zip(starts[at].tolist(), starts[at + 1].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b["block"][i].as_py(), np.int64)), pa.array(at.astype(np.int32)), pa.array(words[at]), pa.array(counts[at]), pa.array(own[at].astype(np.int32)), pa.array(lists, pa.binary())], names=["block", "place", "word", "n", "own", "contexts"])

    return blocks.drop("ids").mapInArrow(told, "block long, place int, word long, n int, own int, contexts binary")


def answers(told: DataFrame, gains: Gains, number: int, least: float) -> DataFrame:
    """block, place, c, class, first: the count of each word over all blocks and the class that fits its contexts best.

    ``first`` marks one place of each word that training texts have. A task holds
    the messages of one batch of words; a word has one message a block at most.
    """
    width = 2 * (number + 1)

    def decided(table: pa.Table) -> pa.RecordBatch:
        word, n, own = (table[c].to_numpy() for c in ("word", "n", "own"))
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        at = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(word))))
        raw = as_bytes(table["contexts"].combine_chunks())
        codes = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
        row = np.repeat(at, np.asarray([len(r) // 4 for r in raw], np.int64))
        sums = np.bincount(row * width + (codes >> COUNT_BITS), weights=codes & ((1 << COUNT_BITS) - 1), minlength=len(starts) * width).reshape(len(starts), width)
        c = np.bincount(at, weights=n, minlength=len(starts)).astype(np.int64)
        classes = np.where(c > 0, gains.best(sums, number, own[starts], least), own[starts])
        first = np.zeros(len(word), bool)
        first[starts[c > 0]] = True
        return pa.RecordBatch.from_arrays([table["block"].combine_chunks(), table["place"].combine_chunks(), pa.array(c[at]), pa.array(classes[at].astype(np.int32)), pa.array(first)], names=["block", "place", "c", "class", "first"])

    def answered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            word = b["word"].to_numpy()
            if held and word[-1] == held[-1]["word"][-1].as_py() == word[0]:
                held.append(b)
                continue
            open_from = int(np.searchsorted(word == word[-1], True)) if word[0] != word[-1] else 0
            if open_from or held:
                cut = open_from if open_from else (0 if not held or held[-1]["word"][-1].as_py() != word[0] else b.num_rows)
                yield decided(pa.Table.from_batches([*held, b.slice(0, cut)]))
                held = [b.slice(cut)] if cut < b.num_rows else []
            else:
                held.append(b)
        if held:
            yield decided(pa.Table.from_batches(held))

    laid = told.repartition("word").sortWithinPartitions("word")
    return laid.mapInArrow(answered, "block long, place int, c long, class int, first boolean")


def score(docs: DataFrame, held: Column, *, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row.

    Rows where ``held`` is true are scored only; a null counts as false. Words
    are split at ASCII white space, A-Z lower-cased, and a text ends with one end
    token, so a null or empty text is scored as an end. Repeated rows count and
    are scored as often as they come; an id may be of any type and a null id
    stays null; an empty table gives an empty result, and without training texts
    every word is unknown. Other columns are not read. Scores are log10
    probabilities; all unknown words are one more type, in base and model alike.
    Every word of the training texts is exchanged, whatever ``shape.core`` is.
    """
    scratch = Scratch(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    id_type, arrow_id = narrow.schema["id"].dataType, arrow_type(narrow, "id")
    blocks = scratch.keep(blocks_of(narrow, id_type))
    core_words, core_counts, core_endings = frequent_words(blocks, shape)
    core, number = len(core_words), shape.classes
    order = np.argsort(core_words)

    def number_of(hashes: np.ndarray, _: np.ndarray) -> np.ndarray:
        """Rank of core words; all others have one number more than the end."""
        if not core:
            return np.full(len(hashes), 1)
        at = np.minimum(np.searchsorted(core_words[order], hashes), core - 1)
        return np.where(core_words[order][at] == hashes, order[at], core + 1)

    pairs = summed_pairs(blocks, number_of, core + 1, core, skip=core + 1)
    classes = exchanged(pairs, core, number, shape.rounds) if core > 1 else np.zeros(core, np.int64)
    model = Classes(core_words, core_endings, core_counts, classes, number)
    grid = np.zeros((number + 1, number + 1))
    for r in summed_pairs(blocks, model.of, number + 1, number).collect():
        grid[divmod(r["code"], number + 1)] = r["n"]

    def with_core(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks with the places and ranks of their core words instead of all words."""
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                ranks = number_of(flat(row["words"]), None)
                ranks[0] = core + 1
                at = np.flatnonzero(ranks < core)
                yield pa.RecordBatch.from_arrays([row["block"], pa.array([len(ranks)], pa.int32()), row["tokens"], row["ids"], row["held"], row["sizes"], one_list(at.astype(np.int32), pa.int32()), one_list(ranks[at].astype(np.int32), pa.int32())], names=["block", "n_words", "tokens", "ids", "held", "sizes", "core_place", "core_rank"])

    # A block's own counts of core words don't matter, only those of all blocks: one more sum over blocks, of no more than core rows each.
    core_sums = exact_counts(blocks, core_words)

    def labelled(left: pa.Table, right: pa.Table) -> pa.Table:
        """Each text with its classes (plus number + 1 where the word is unknown), sums of logarithms of counts, and, in a block's first text, what the block adds to the totals."""
        if not left.num_rows:
            return pa.table({c: pa.array([], t) for c, t in out})
        row = left.combine_chunks().to_batches()[0]
        n_words = row["n_words"][0].as_py()
        count, own = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
        place = right["place"].to_numpy()
        count[place], own[place] = right["c"].to_numpy(), right["class"].to_numpy()
        at, rank = flat(row["core_place"]), flat(row["core_rank"])
        count[at], own[at] = core_sums[rank], classes[rank]
        count[0], own[0] = ends, number
        tokens, in_held, sizes = unpacked(row["tokens"][0].as_py()), flat(row["held"]), flat(row["sizes"]).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        told = (own + np.where(count > 0, 0, number + 1))[tokens].astype("<u2")
        known = (count > 0)[tokens]
        first_types = int(right["first"].to_numpy(zero_copy_only=False).sum())
        once = np.bincount(own[tokens[~np.repeat(in_held, sizes) & (count == 1)[tokens]]], minlength=number + 1)
        sequences = [told[s : s + n].tobytes() for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
        block_sums = [np.append(once, first_types).tolist()] + [None] * (len(sizes) - 1)
        columns = [row["ids"].flatten(), row["held"].flatten(), pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(np.log10(count + 1.0)[tokens], starts)), pa.array(np.add.reduceat(np.log10(np.maximum(count, 1))[tokens], starts)), pa.array(sequences, pa.binary()), pa.array(block_sums, pa.list_(pa.int64()))]
        return pa.Table.from_arrays(columns, names=[c for c, _ in out])

    out = [("id", arrow_id), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("plus_one", pa.float64()), ("logs", pa.float64()), ("seq", pa.binary()), ("sums", pa.list_(pa.int64()))]
    core_schema = f"block long, n_words int, tokens binary, ids array<{id_type.simpleString()}>, held array<boolean>, sizes array<int>, core_place array<int>, core_rank array<int>"
    n_blocks, ends = blocks.agg(F.count("*"), F.coalesce(F.sum(F.element_at("counts", 1)), F.lit(0))).first()
    tasks = max(1, min(n_blocks, 20_000))  # so that a task holds few blocks, each of which is bounded by bytes
    replies = answers(messages(blocks, model, number), Gains(grid), number, shape.gain)
    left = blocks.mapInArrow(with_core, core_schema).repartition(tasks, "block").groupBy("block")
    found = left.cogroup(replies.repartition(tasks, "block").groupBy("block")).applyInArrow(labelled, f"id {id_type.simpleString()}, held boolean, n_tokens long, n_known long, plus_one double, logs double, seq binary, sums array<long>")
    texts = scratch.keep(found)

    sums = texts.filter("sums is not null").select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(number + 2, np.int64)
    for r in sums:
        totals[r["at"]] = r["n"]
    seen_once, tokens = totals[: number + 1], texts.filter("not held").agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    types = int(totals[-1]) + int((core_sums > 0).sum()) + int(ends > 0)
    grid = np.zeros((number + 1, number + 1))
    for r in class_bigrams(texts, number).collect():
        grid[r["own"], r["near"]] = r["n"]
    held_by = grid.sum(0)
    unknown = (seen_once + 0.5) / (held_by + 1)
    prior = (held_by + 1) / (grid.sum() + number + 1)
    after = np.log10((grid + (number + 1) * prior) / (grid.sum(1, keepdims=True) + number + 1))
    # What a token adds besides its class and the logarithm of its count: first for known words, then for unknown ones.
    share = np.append(unknown[:number], 0.0)
    emitted = np.concatenate([np.log10(1 - share) - np.log10(np.maximum(held_by, 1)), np.log10(np.where(share > 0, share, 1.0))])

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = []
            for raw in as_bytes(b["seq"]):
                told = np.frombuffer(raw, "<u2").astype(np.int64)
                now = told % (number + 1)
                values.append(float(after[np.concatenate([[number], now[:-1]]), now].sum() + emitted[told].sum()))
            n, logs = b["n_tokens"].to_numpy(), b["logs"].to_numpy()
            total = np.asarray(values) + logs
            base = b["plus_one"].to_numpy() - n * np.log10(tokens + types + 1)
            yield pa.RecordBatch.from_arrays([b["id"], b["held"], b["n_tokens"], b["n_known"], pa.array(np.full(len(n), tokens, np.int64)), pa.array(base), pa.array(total), pa.array(10 ** np.minimum(-total / n, 300))], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    schema = f"id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return texts.select("id", "held", "n_tokens", "n_known", "plus_one", "logs", "seq").mapInArrow(scored, schema).withColumnRenamed("id", id_col)


def exact_counts(blocks: DataFrame, words: np.ndarray) -> np.ndarray:
    """How often all training texts together have each of a bounded list of words."""
    order = np.argsort(words)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(words), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                own, n = flat(b["words"].slice(i, 1)), flat(b["counts"].slice(i, 1))
                at = np.minimum(np.searchsorted(words[order], own), len(words) - 1)
                hit = words[order][at] == own
                sums[order[at[hit]]] += n[hit]
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], names=["at", "n"])

    out = np.zeros(len(words), np.int64)
    if len(words):
        for r in blocks.select("words", "counts").mapInArrow(counted, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            out[r["at"]] = r["n"]
    return out


def class_bigrams(texts: DataFrame, number: int) -> DataFrame:
    """own, near, n: how often a class follows another in training texts."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros((number + 1) ** 2, np.int64)
        for b in batches:
            for raw in as_bytes(b["seq"]):
                now = np.frombuffer(raw, "<u2").astype(np.int64) % (number + 1)
                grid += np.bincount(np.concatenate([[number], now[:-1]]) * (number + 1) + now, minlength=len(grid))
        there = np.flatnonzero(grid)
        yield pa.RecordBatch.from_arrays([pa.array(there // (number + 1)), pa.array(there % (number + 1)), pa.array(grid[there])], names=["own", "near", "n"])

    return texts.filter("not held").select("seq").mapInArrow(counted, "own long, near long, n long").groupBy("own", "near").agg(F.sum("n").alias("n"))
