"""Summaries of coverage in bins that grow from level to level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a bin tells: bases with coverage, least and greatest depth, sums of depths and of their squares over bases.
SUMMARY = ("valid", "least", "most", "total", "squares")


def first_level(runs: DataFrame, by: tuple[str, ...], size: int) -> DataFrame:
    """``by``, chrom, bin and the SUMMARY of bins of ``size`` bases. A run gives each bin it reaches its share."""
    bins = F.sequence(F.floor(F.col("start_pos") / size), F.floor((F.col("end_pos") - 1) / size))
    shared = runs.select(*by, "chrom", "start_pos", "end_pos", "depth", F.explode(bins).alias("bin"))
    bases = F.least("end_pos", (F.col("bin") + 1) * size) - F.greatest("start_pos", F.col("bin") * size)
    told = shared.withColumns({"valid": bases.cast("long"), "least": F.col("depth"), "most": F.col("depth"), "total": bases * F.col("depth"), "squares": bases * F.col("depth") * F.col("depth")})
    return summed(told, by)


def summed(bins: DataFrame, by: tuple[str, ...]) -> DataFrame:
    sums = [F.min("least").alias("least"), F.max("most").alias("most"), *(F.sum(c).alias(c) for c in ("valid", "total", "squares"))]
    return bins.groupBy(*by, "chrom", "bin").agg(*sums).select(*by, "chrom", "bin", *SUMMARY)


def pyramid(runs: DataFrame, by: tuple[str, ...] = (), *, size: int, levels: int, times: int = 4) -> DataFrame:
    """level (from 1), ``by``, chrom, start_pos, end_pos and the SUMMARY of all bins that have coverage.

    Bins of a level are ``times`` as long as those before, and are summed from
    them: one aggregate a level, each over that many rows less.
    """
    found, bins = [], first_level(runs, by, size)
    for level in range(1, levels + 1):
        own = size * times ** (level - 1)
        found.append(bins.select(F.lit(level).alias("level"), *by, "chrom", (F.col("bin") * own).alias("start_pos"), ((F.col("bin") + 1) * own).alias("end_pos"), *SUMMARY))
        bins = summed(bins.withColumn("bin", F.floor(F.col("bin") / times)), by)
    return reduce(DataFrame.unionByName, found)
