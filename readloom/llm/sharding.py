"""Operator 12: a uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in the partitions they were read in, and go to blocks of places, several
to a shard. How many rows of a partition go to each block is drawn first, as the
hypergeometric law has it when all rows are permuted uniformly. The draw splits
the partitions in halves, and each task follows the halves down to its own
partition, so nobody holds the matrix. A partition's rows are then permuted, cut
by these counts and exchanged, and each block permutes what it got.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch

#: Rows that numpy draws from at most in its hypergeometric law.
NUMPY_ROWS = 999_999_999
#: Bits of a row's number within its partition, as Spark's increasing ids have them.
ROW_BITS = 33
#: Names of working columns.
PLACE, SENT, WITHIN, BLOCK, FIRST = (f"sharding_{n}" for n in ("place", "sent", "within", "block", "first"))
#: Streams of random numbers.
SPLIT, LOCAL = 1, 2


def stream(seed: int, kind: int, *at: int) -> np.random.Generator:
    """The random numbers of one draw; every task that makes it gets the same."""
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, kind, *at])))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows are good; beyond numpy's limit by inverting the law around its mode."""
    if good + bad <= NUMPY_ROWS:
        return int(rng.hypergeometric(good, bad, drawn))
    low, high = max(0, drawn - bad), min(good, drawn)
    total = good + bad
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1))) ** 0.5
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    first, last = max(low, mode - int(12 * spread) - 50), min(high, mode + int(12 * spread) + 50)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    weight = np.exp((told := np.concatenate([[0.0], np.cumsum(steps)])) - told.max())
    total_weight = np.cumsum(weight)
    return first + int(np.searchsorted(total_weight, rng.random() * total_weight[-1], side="right"))


def drawn_from(rng: np.random.Generator, colours: np.ndarray, drawn: int) -> np.ndarray:
    """How many of ``drawn`` rows have each colour, without putting back."""
    total = int(colours.sum())
    if total <= NUMPY_ROWS:
        return rng.multivariate_hypergeometric(colours, drawn, method="marginals")
    if len(colours) == 1:
        return np.asarray([drawn], np.int64)
    half = len(colours) // 2
    left = int(colours[:half].sum())
    there = hypergeometric(rng, left, total - left, drawn)
    return np.concatenate([drawn_from(rng, colours[:half], there), drawn_from(rng, colours[half:], drawn - there)])


def matrix_row(seed: int, before: np.ndarray, columns: np.ndarray, part: int) -> np.ndarray:
    """Rows of one partition for each block. ``before``: rows of the partitions before each one, and all at the end."""
    low, high, colours = 0, len(before) - 1, columns
    while high - low > 1:
        middle = (low + high) // 2
        left = drawn_from(stream(seed, SPLIT, low, high), colours, int(before[middle] - before[low]))
        if part < middle:
            high, colours = middle, left
        else:
            low, colours = middle, colours - left
    return colours


def even(total: int, parts: int) -> np.ndarray:
    """Sizes that are at most one apart, the larger ones first."""
    return np.asarray([total // parts + (i < total % parts) for i in range(parts)], np.int64)


def blocks_of(rows: int, shards: int, block_rows: int, most_blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, first slot, rows) of each block; blocks grow where there would be too many."""
    limit = max(block_rows, -(-rows // most_blocks))
    cut = [even(int(n), max(1, -(-int(n) // limit))) for n in even(rows, shards)]
    shard = np.repeat(np.arange(shards), [len(c) for c in cut])
    return shard, np.concatenate([np.cumsum(c) - c for c in cut]), np.concatenate(cut)


def shuffle_into_shards(docs: DataFrame, *, shards: int = 8, seed: int = 12, block_rows: int = 10_000, most_blocks: int = 100_000) -> DataFrame:
    """All columns of ``docs``, shard and slot of every row: a uniform random order, cut into shards.

    Shards are at most one row apart, slots are gapless from 0 in each. Rows are
    rows, whatever they hold: nulls, empty or very long texts and repeated rows go
    their own ways, and equal texts are not kept together. An empty table gives an
    empty result. Columns named shard or slot are replaced.

    The order follows from ``seed``, the partitions of ``docs`` and the order of
    rows in them, which the first pass writes down, so a task that is run again
    does as before. Rows go through one exchange. The driver knows each
    partition's number of rows; a task keeps the permutation of one partition
    and one row of the matrix, of ``most_blocks`` + ``shards`` numbers at most.
    """
    scratch = Scratch(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    lain = scratch.keep(docs.select(*(docs[c] for c in kept)).withColumn(PLACE, F.monotonically_increasing_id()))
    sizes = sorted(tuple(r) for r in lain.groupBy(F.shiftright(PLACE, ROW_BITS)).agg(F.count("*")).collect())
    number = {p: i for i, (p, _) in enumerate(sizes)}
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).astype(np.int64)
    shard, first, columns = blocks_of(int(before[-1]), shards, block_rows, most_blocks)

    @F.arrow_udf("struct<block:int,turn:long>")
    def dealt(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """The block of each row, and its turn in the block's last permutation."""
        now, order, turns, ends = None, None, None, None
        for batch in batches:
            place = batch.to_numpy(zero_copy_only=False)
            block, turn = np.zeros(len(place), np.int32), np.zeros(len(place), np.int64)
            parts = place >> ROW_BITS
            for p in np.unique(parts):
                if p != now:
                    i = number[int(p)]
                    rng, n = stream(seed, LOCAL, i), int(before[i + 1] - before[i])
                    order, turns = rng.permutation(n), rng.integers(0, 1 << 62, n)
                    now, ends = p, np.cumsum(matrix_row(seed, before, columns, i))
                own = parts == p
                at = place[own] & ((1 << ROW_BITS) - 1)
                block[own], turn[own] = np.searchsorted(ends, order[at], side="right"), turns[at]
            yield pa.StructArray.from_arrays([pa.array(block), pa.array(turn)], names=["block", "turn"])

    layout = docs.sparkSession.createDataFrame([(i, int(s), int(f)) for i, (s, f) in enumerate(zip(shard, first, strict=True))], f"{BLOCK} int, shard int, {FIRST} long")
    sent = lain.withColumn(SENT, dealt(PLACE))
    within = F.row_number().over(Window.partitionBy(f"{SENT}.block").orderBy(f"{SENT}.turn", PLACE)) - 1
    placed = sent.withColumn(WITHIN, within).join(F.broadcast(layout), F.col(f"{SENT}.block") == F.col(BLOCK))
    return placed.select(*kept, "shard", (F.col(FIRST) + F.col(WITHIN)).alias("slot"))
