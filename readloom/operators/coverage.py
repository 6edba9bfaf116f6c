"""Coverage and crosslink tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bases of a bin of the running sums.
BIN = 100_000


def depth_changes(bed: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Change of depth at each place where it changes."""
    kept = [*by, "chrom", "strand"]
    ends = F.explode(F.array(F.struct(F.col("start_pos").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end_pos").alias("pos"), F.lit(-1).alias("d")))).alias("e")
    return bed.select(*kept, ends).select(*kept, "e.pos", "e.d").groupBy(*kept, "pos").agg(F.sum("d").alias("d")).filter("d <> 0")


def coverage(bed: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Maximal runs of one depth above zero: ``by``, chrom, strand, start_pos, end_pos, depth.

    Changes of depth are summed by place before the shuffle. Running sums are
    taken within bins, and sums of bins carried over, so one chromosome is not
    one task.
    """
    return runs_of(depth_changes(bed, by), by)


def runs_of(changes: DataFrame, by: tuple[str, ...]) -> DataFrame:
    group = [*by, "chrom", "strand"]
    binned = changes.withColumn("bin", F.floor(F.col("pos") / BIN))
    bins = Window.partitionBy(*group).orderBy("bin")
    sums = binned.groupBy(*group, "bin").agg(F.sum("d").alias("total"), F.min("pos").alias("first"))
    carried = sums.select(*group, "bin", (F.sum("total").over(bins) - F.col("total")).alias("before"), F.lead("first").over(bins).alias("next_first"))
    inside = Window.partitionBy(*group, "bin").orderBy("pos")
    swept = binned.withColumns({"run": F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("pos").over(inside)})
    joined = swept.join(carried, [*group, "bin"])
    out = joined.select(*group, F.col("pos").alias("start_pos"), F.coalesce("next", "next_first").alias("end_pos"), (F.col("before") + F.col("run")).cast("long").alias("depth"))
    return out.filter("depth > 0")


def merged_coverage(bed: DataFrame, by: tuple[str, ...], apart: str) -> tuple[DataFrame, DataFrame]:
    """Coverage with and without the column ``apart``; the second sums the changes of the first."""
    changes = depth_changes(bed, (*by, apart))
    whole = changes.groupBy(*by, "chrom", "strand", "pos").agg(F.sum("d").alias("d")).filter("d <> 0")
    return runs_of(changes, (*by, apart)), runs_of(whole, by)


def crosslinks(bed: DataFrame) -> DataFrame:
    """The base before each read on its strand; sites that start at 0 or before are dropped."""
    forward = F.col("strand") == "+"
    start = F.when(forward, F.col("start_pos") - 1).otherwise(F.col("end_pos"))
    end = F.when(forward, F.col("start_pos")).otherwise(F.col("end_pos") + 1)
    return bed.withColumns({"start_pos": start, "end_pos": end}).filter("start_pos > 0")


def within_chromosomes(bed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows that end within their chromosome."""
    return bed.join(sizes.select("chrom", "size"), "chrom").filter("end_pos <= size").drop("size")
