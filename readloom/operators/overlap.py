"""Mates merged where they overlap best, mismatches included."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.sequence import revcomp
from readloom.operators.merge import place_of

#: Phred+33: the sign of quality 0; the greatest quality of a base that both reads say, and the least of one they differ on.
ZERO, HIGHEST, LOWEST = 33, 41, 2
#: Pairs that are aligned together.
TOGETHER = 2000


def aligned(texts: list[bytes], width: int, right: bool) -> np.ndarray:
    """Texts as rows of one width, at its right or left end, zeros elsewhere."""
    packed = b"".join(t.rjust(width, b"\0") if right else t.ljust(width, b"\0") for t in texts)
    return np.frombuffer(packed, np.uint8).reshape(len(texts), width)


def best_overlaps(seq: list[bytes], qual: list[bytes], other: list[bytes], other_qual: list[bytes], least: int, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bases of the overlap or 0, mismatches, score) of each pair; ``other`` is turned to the first read's strand.

    The score adds the lesser quality where the bases are equal and takes it off
    where they differ; an N counts nothing. An overlap has ``least`` bases or more, at most
    ``rate`` mismatches a base and a score above 0. The greatest score wins, then the longest overlap.
    """
    rows = len(seq)
    sizes = np.asarray([min(len(a), len(b)) for a, b in zip(seq, other, strict=True)], np.int64)
    width = max(map(len, [*seq, *other]), default=0)
    a, qa = aligned(seq, width, True), aligned(qual, width, True).astype(np.int16) - ZERO
    b, qb = aligned(other, width, False), aligned(other_qual, width, False).astype(np.int16) - ZERO
    overlap, mismatches, score = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for n in range(max(1, least), int(sizes.max(initial=0)) + 1):
        fit = np.flatnonzero(sizes >= n)
        x, y = a[fit, width - n :], b[fit, :n]
        weight = np.minimum(qa[fit, width - n :], qb[fit, :n])
        weight = np.where((x == ord("N")) | (y == ord("N")), 0, weight)
        differ = (x != y) & (x != ord("N")) & (y != ord("N"))
        wrong, told = differ.sum(1), np.where(differ, -weight, weight).sum(1, dtype=np.int64)
        better = (wrong <= rate * n) & (told > 0) & (told >= score[fit])
        place = fit[better]
        overlap[place], mismatches[place], score[place] = n, wrong[better], told[better]
    return overlap, mismatches, score


def consensus(seq: bytes, qual: bytes, other: bytes, other_qual: bytes, n: int) -> tuple[str, str]:
    """The merged read. Equal bases add their qualities; of differing ones the better stays, with what it is better by; a base stands against an N."""
    x, y = np.frombuffer(seq[len(seq) - n :], np.uint8), np.frombuffer(other[:n], np.uint8)
    p, q = (np.frombuffer(t, np.uint8).astype(np.int16) - ZERO for t in (qual[len(qual) - n :], other_qual[:n]))
    first = np.where(x == ord("N"), y == ord("N"), (y == ord("N")) | (p >= q))
    single = (x == ord("N")) ^ (y == ord("N"))
    quality = np.where(x == y, np.minimum(p + q, HIGHEST), np.where(single, np.where(first, p, q), np.maximum(np.abs(p - q), LOWEST)))
    bases = np.where(first, x, y).astype(np.uint8).tobytes()
    return (seq[: len(seq) - n] + bases + other[n:]).decode(), (qual[: len(qual) - n] + (quality + ZERO).astype(np.uint8).tobytes() + other_qual[n:]).decode()


def overlap_of(seq: Column, qual: Column, other: Column, other_qual: Column, least: int, rate: float) -> Column:
    """struct of overlap, mismatches, score and the merged seq and qual, null without an overlap."""

    @F.arrow_udf("struct<overlap:int,mismatches:int,score:int,seq:string,qual:string>")
    def told(s: pa.Array, q: pa.Array, o: pa.Array, p: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(s), TOGETHER):
            texts = [[(t or "").encode() for t in c.slice(at, TOGETHER).to_pylist()] for c in (s, q, o, p)]
            for i, (n, wrong, score) in enumerate(zip(*(x.tolist() for x in best_overlaps(*texts, least, rate)), strict=True)):
                merged = consensus(*(t[i] for t in texts), n) if n else (None, None)
                out.append({"overlap": n, "mismatches": wrong, "score": score, "seq": merged[0], "qual": merged[1]} if n else None)
        return pa.array(out, pa.struct([("overlap", pa.int32()), ("mismatches", pa.int32()), ("score", pa.int32()), ("seq", pa.string()), ("qual", pa.string())]))

    return told(seq, qual, other, other_qual)


def merge_mates_by_score(pairs: DataFrame, *, min_overlap: int = 12, min_insert: int = 30, max_mismatch_rate: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """Merged reads (name, seq, qual, overlap, mismatches), and the pairs left over; see ``best_overlaps`` and ``consensus``.

    With a rate of 0 only exact overlaps count, and with one quality for all bases the
    longest of them wins, as in ``merge_mates``. The merged read has ``min_insert`` bases at
    least. A null or empty read overlaps nothing. Nothing is shuffled.
    """
    found = pairs.withColumn("merged_mates", overlap_of(F.col("seq_f"), F.col("qual_f"), revcomp(F.col("seq_r")), F.reverse("qual_r"), min_overlap, max_mismatch_rate))
    merges = F.coalesce(F.length("merged_mates.seq") >= min_insert, F.lit(False))
    merged = found.filter(merges).select(*place_of(pairs), F.col("name_f").alias("name"), "merged_mates.seq", "merged_mates.qual", "merged_mates.overlap", "merged_mates.mismatches")
    return merged, found.filter(~merges).select(*pairs.columns)
