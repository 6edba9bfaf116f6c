"""Adapters at the end of reads, found with mismatches and cut off."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reads that are searched together.
TOGETHER = 5000


def adapter_places(seqs: list[bytes], adapter: bytes, least: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(where the adapter starts in each read, its length without one; mismatches).

    The adapter, or as much of it as the read's end leaves, covers ``least`` bases or
    more with at most ``rate`` mismatches a base. An N of the adapter fits any base.
    The place with most matches less mismatches wins, then the first one.
    """
    sizes = np.asarray([len(s) for s in seqs], np.int64)
    width, wanted = int(sizes.max(initial=0)), np.frombuffer(adapter, np.uint8)
    reads = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in seqs), np.uint8).reshape(len(seqs), width)
    place, wrong, best = sizes.copy(), np.zeros(len(seqs), np.int64), np.full(len(seqs), -1)
    for at in range(width):
        n = min(len(wanted), width - at)
        covered = np.clip(sizes - at, 0, n)
        there = np.arange(n)[None] < covered[:, None]
        differ = ((reads[:, at : at + n] != wanted[None, :n]) & (wanted[None, :n] != ord("N")) & there).sum(1)
        score = covered - 2 * differ
        better = (covered >= max(1, least)) & (differ <= rate * covered) & (score > best)
        place[better], wrong[better], best[better] = at, differ[better], score[better]
    return place, wrong


def adapter_in(seq: Column, adapter: str, least: int, rate: float) -> Column:
    """struct of place (bases in front of the adapter) and mismatches, null in a null read."""
    wanted = adapter.upper().encode()

    @F.arrow_udf("struct<place:int,mismatches:int>")
    def found(seqs: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(seqs), TOGETHER):
            texts = seqs.slice(at, TOGETHER).to_pylist()
            places, wrong = adapter_places([(t or "").encode() for t in texts], wanted, least, rate)
            out += [None if t is None else {"place": p, "mismatches": w} for t, p, w in zip(texts, places.tolist(), wrong.tolist(), strict=True)]
        return pa.array(out, pa.struct([("place", pa.int32()), ("mismatches", pa.int32())]))

    return found(seq)


def trim_adapter(reads: DataFrame, adapter: str, *, seq: str = "seq", qual: str = "qual", min_overlap: int = 3, max_error: float = 0.1) -> DataFrame:
    """Reads without the adapter and what follows it, and its number of mismatches (null without an adapter). Nothing is shuffled."""
    if not adapter or set(adapter.upper()) - set("ACGTN"):
        raise ValueError(f"not an adapter: {adapter!r}")
    found = reads.withColumn("adapter_found", adapter_in(F.col(seq), adapter, min_overlap, max_error))
    place = F.col("adapter_found.place")
    there = place < F.length(seq)
    return found.withColumns({"adapter_mismatches": F.when(there, F.col("adapter_found.mismatches")), seq: F.substring(seq, F.lit(1), place), qual: F.substring(qual, F.lit(1), place)}).drop("adapter_found")
