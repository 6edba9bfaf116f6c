"""Reads placed on a reference: shared minimizers, votes for a diagonal, and alignment within the window it tells.

Reference and reads meet by an equi-join on minimizers, windows by a join on pieces of
the reference, so neither is held by a task. Equal reads are aligned once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.sequence import revcomp

#: Bases of a piece of the reference, and of the next piece that it has too.
PIECE, SHARED = 10_000, 1_000
#: Bases of the reference whose seeds a task cuts, and as many a task counts, about.
TASK_BASES = 1 << 20
#: Windows that are aligned together.
TOGETHER = 500
CODES = np.full(256, 4, np.uint8)
CODES[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3] * 2


class Shape(NamedTuple):
    """Parameters: bases of a seed and seeds a minimizer is the least of; places a seed may have in the reference; diagonals tried for a read; bases around a window; scores; the share of the greatest possible score that a read must reach."""

    seed: int = 15
    window: int = 5
    most_places: int = 500
    tried: int = 8
    around: int = 16
    match: int = 2
    mismatch: int = -3
    gap: int = -6
    least: float = 0.5


def minimizers(seq: bytes, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, whether it is that of the turned seed) of the least hashes of all runs of ``w`` seeds; seeds with other letters than A, C, G and T have none."""
    codes = CODES[np.frombuffer(seq, np.uint8)].astype(np.uint64)
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
    forward, back = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for i in range(k):
        part = codes[i : i + n]
        forward = forward << np.uint64(2) | (part & np.uint64(3))
        back |= (np.uint64(3) - (part & np.uint64(3))) << np.uint64(2 * i)
    bad = np.convolve(codes == 4, np.ones(k, int))[k - 1 : k - 1 + n] > 0
    # A seed that is its own reverse complement would fit both strands alike.
    bad |= forward == back
    turned = back < forward
    hashes = np.minimum(forward, back) * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    hashes[bad] = np.uint64(0xFFFFFFFFFFFFFFFF)
    width = min(w, n)
    runs = np.lib.stride_tricks.sliding_window_view(hashes, width)
    places = np.unique(runs.argmin(1) + np.arange(len(runs)))
    places = places[~bad[places]]
    return hashes[places].view(np.int64), places.astype(np.int32), turned[places]


def seeds_of(rows: DataFrame, key: str, shape: Shape) -> DataFrame:
    """key, seed, place, turned of the minimizers of ``seq``."""
    kind = dict(rows.dtypes)[key]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [minimizers((s or "").encode(), shape.seed, shape.window) for s in b["text"].to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            whole = [np.concatenate(x) if found else np.zeros(0, t) for x, t in zip(zip(*found, strict=True) if found else [()] * 3, (np.int64, np.int32, bool), strict=True)]
            yield pa.RecordBatch.from_arrays([b["of"].take(pa.array(at)), *map(pa.array, whole)], names=[key, "seed", "place", "turned"])

    return rows.select(F.col(key).alias("of"), F.col("seq").alias("text")).mapInArrow(cut, f"{key} {kind}, seed long, place int, turned boolean")


def pieces(contigs: DataFrame) -> DataFrame:
    """chrom, piece, seq: overlapping pieces of contigs (chrom, seq)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chrom, seq in zip(b["chrom"].to_pylist(), b["seq"].to_pylist(), strict=True):
                for at in range(0, len(seq or ""), PIECE):
                    yield pa.RecordBatch.from_arrays([pa.array([chrom]), pa.array([at // PIECE], pa.int32()), pa.array([seq[at : at + PIECE + SHARED]])], names=["chrom", "piece", "seq"])

    return contigs.select("chrom", "seq").mapInArrow(cut, "chrom string, piece int, seq string")


def tasks_for(contigs: DataFrame) -> int:
    """Tasks of about TASK_BASES each."""
    return 1 + (contigs.agg(F.sum(F.length("seq").cast("long"))).first()[0] or 0) // TASK_BASES


def aligned(reads: list[bytes], windows: list[bytes], shape: Shape) -> list[tuple[int, int, str, int]]:
    """(score, start in the window, CIGAR, mismatches and gap bases) of whole reads of one length within windows of one length."""
    n, m = len(reads[0]), len(windows[0])
    x, y = (np.frombuffer(b"".join(t), np.uint8).reshape(len(t), -1) for t in (reads, windows))
    grid = np.zeros((n + 1, len(reads), m + 1), np.int32)
    slope = shape.gap * np.arange(m + 1)
    for i in range(1, n + 1):
        grid[i, :, 0] = i * shape.gap
        same = (x[:, i - 1 : i] == y) & (CODES[y] < 4)
        step = np.maximum(grid[i - 1, :, :-1] + np.where(same, shape.match, shape.mismatch), grid[i - 1, :, 1:] + shape.gap)
        row = np.concatenate([grid[i, :, :1], step], 1)
        grid[i] = np.maximum.accumulate(row - slope, 1) + slope
    out = []
    ends = grid[n].argmax(1)
    for r, j in enumerate(ends.tolist()):
        i, ops, wrong = n, [], 0
        while i:
            fits = j and reads[r][i - 1] == windows[r][j - 1] and CODES[reads[r][i - 1]] < 4
            if j and grid[i, r, j] == grid[i - 1, r, j - 1] + (shape.match if fits else shape.mismatch):
                ops.append("M")
                wrong += not fits
                i, j = i - 1, j - 1
            elif grid[i, r, j] == grid[i - 1, r, j] + shape.gap:
                ops.append("I")
                wrong, i = wrong + 1, i - 1
            else:
                ops.append("D")
                wrong, j = wrong + 1, j - 1
        cigar = "".join(f"{len(m[0])}{m[0][0]}" for m in re.finditer(r"M+|I+|D+", "".join(reversed(ops))))
        out.append((int(grid[n, r].max()), j, cigar, wrong))
    return out


def in_windows(candidates: DataFrame, shape: Shape) -> DataFrame:
    """Adds score, pos, cigar and wrong to candidates (oriented, window, start and columns that are kept)."""

    @F.arrow_udf("struct<score:int,at:int,cigar:string,wrong:int>")
    def told(reads: pa.Array, windows: pa.Array) -> pa.Array:
        texts = [(a.encode(), b.encode()) for a, b in zip(reads.to_pylist(), windows.to_pylist(), strict=True)]
        out: list[dict | None] = [None] * len(texts)
        by_size: dict[tuple[int, int], list[int]] = {}
        for i, (a, b) in enumerate(texts):
            by_size.setdefault((len(a), len(b)), []).append(i)
        for (n, m), rows in by_size.items():
            for s in range(0, len(rows) if n and m else 0, TOGETHER):
                own = rows[s : s + TOGETHER]
                for i, found in zip(own, aligned([texts[i][0] for i in own], [texts[i][1] for i in own], shape), strict=True):
                    out[i] = dict(zip(("score", "at", "cigar", "wrong"), found, strict=True))
        return pa.array(out, pa.struct([("score", pa.int32()), ("at", pa.int32()), ("cigar", pa.string()), ("wrong", pa.int32())]))

    found = candidates.withColumn("found", told("oriented", "window"))
    return found.select("seq", "chrom", "back", (F.col("start") + F.col("found.at") + 1).alias("pos"), "found.score", "found.cigar", "found.wrong")


def align_reads(reads: DataFrame, contigs: DataFrame, *, shape: Shape = Shape()) -> DataFrame:
    """The columns of SAM lines, tags NM and AS among them, for reads (name, seq, qual); what fits nowhere well enough is unmapped.

    ``contigs``: chrom, seq. A read is aligned from end to end, with the greatest score of all diagonals that its seeds
    vote for most; of equal ones the first by chromosome, place and strand is told. mapq grows with the distance to the
    next best place. Seeds with more than ``shape.most_places`` places are left out. Reads longer than SHARED less what is
    around a window can't be aligned and stay unmapped, as null and empty ones do.
    """
    k = shape.seed
    laid = pieces(contigs)
    own_part = F.col("place") < PIECE
    # A file of few megabytes can tell many contigs, and few small tasks are merged: both numbers of tasks grow with the bases.
    tasks = tasks_for(contigs)
    there = seeds_of(laid.repartition(tasks, "chrom", "piece").withColumn("at", F.struct("chrom", "piece")), "at", shape).filter(own_part)
    there = there.select("seed", F.col("at.chrom").alias("chrom"), (F.col("at.piece") * PIECE + F.col("place")).alias("ref"), F.col("turned").alias("ref_turned")).repartition(tasks, "seed").distinct()
    rare = there.groupBy("seed").agg(F.count("*").alias("n")).filter(F.col("n") <= shape.most_places).select("seed")
    # By the size of its file Spark would take the reference for a small table and give it to every task.
    there = there.join(rare.hint("merge"), "seed").hint("merge")
    upper = F.upper(F.trim("seq"))
    distinct = reads.select(upper.alias("seq")).filter((F.col("seq") != "") & (F.length("seq") <= SHARED - 2 * shape.around)).distinct()
    met = seeds_of(distinct, "seq", shape).join(there, "seed")
    back = F.col("turned") != F.col("ref_turned")
    place = F.when(back, F.length("seq") - k - F.col("place")).otherwise(F.col("place"))
    voted = met.select("seq", "chrom", back.alias("back"), (F.col("ref") - place).alias("diagonal")).groupBy("seq", "chrom", "back", F.floor(F.col("diagonal") / shape.around).alias("bin")).agg(F.count("*").alias("votes"), F.min("diagonal").alias("diagonal"))
    order = Window.partitionBy("seq").orderBy(F.desc("votes"), "chrom", "diagonal", "back")
    tried = voted.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= shape.tried)
    start = F.greatest(F.col("diagonal") - shape.around, F.lit(0))
    placed = tried.select("seq", "chrom", "back", start.alias("start"), F.floor(start / PIECE).cast("int").alias("piece"))
    window = F.substring("piece_seq", (F.col("start") - F.col("piece") * PIECE + 1).cast("int"), F.length("seq") + 3 * shape.around)
    windows = placed.join(laid.withColumnRenamed("seq", "piece_seq").hint("merge"), ["chrom", "piece"]).select("seq", "chrom", "back", "start", F.when(F.col("back"), revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("oriented"), F.upper(window).alias("window"))
    found = in_windows(windows, shape).filter(F.col("score") >= shape.least * shape.match * F.length("seq"))
    best = found.dropDuplicates(["seq", "chrom", "back", "pos", "cigar"]).groupBy("seq").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "chrom", "pos", "back", "cigar", "wrong"))).alias("all"))
    first, second = F.col("all")[0], F.coalesce(-F.get("all", F.lit(1))["minus"], F.lit(0))
    mapq = F.least(F.lit(60), F.floor(60 * (-first["minus"] - second) / (shape.match * F.length("seq")) * 2)).cast("int")
    told = best.select(F.col("seq").alias("read_seq"), first["chrom"].alias("chrom"), first["pos"].alias("pos"), first["back"].alias("back"), first["cigar"].alias("cigar"), first["wrong"].alias("wrong"), (-first["minus"]).alias("score"), mapq.alias("mapq"))
    joined = reads.withColumn("read_seq", upper).join(told, "read_seq", "left")
    mapped, turned = F.col("chrom").isNotNull(), F.coalesce("back", F.lit(False))
    star, zero = F.lit("*"), F.lit(0).cast("long")
    tags = F.when(mapped, F.array(F.concat(F.lit("NM:i:"), F.col("wrong")), F.concat(F.lit("AS:i:"), F.col("score")))).otherwise(F.array().cast("array<string>"))
    shown = lambda column, other: F.coalesce(F.when(F.length(column) > 0, F.when(turned, other).otherwise(column)), star)
    return joined.select(
        F.regexp_replace(F.element_at(F.split("name", " "), 1), "^@", "").alias("qname"),
        F.when(~mapped, 4).when(turned, 16).otherwise(0).alias("flag"),
        F.coalesce("chrom", star).alias("rname"),
        F.coalesce("pos", zero).cast("long").alias("pos"),
        F.coalesce("mapq", F.lit(0)).alias("mapq"),
        F.coalesce("cigar", star).alias("cigar"),
        star.alias("rnext"),
        zero.alias("pnext"),
        zero.alias("tlen"),
        shown(F.col("read_seq"), revcomp(F.col("read_seq"))).alias("seq"),
        shown(F.col("qual"), F.reverse("qual")).alias("qual"),
        tags.alias("tags"),
    )
