"""Records that span several lines of text files, by Spark's own readers.

Lines are numbered within their file from the blocks they were read in, so plain
files are split and any file system or compression that Spark reads will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, file_no (in order of names, from 1), line_no (from 0), value.

    A block's lines come in order, so a line's number is its place within the
    block plus the lines of the file's blocks before it; only one row per block
    is sorted, and one per file is numbered.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    number = F.dense_rank().over(Window.orderBy("file"))
    placed = blocks.select("file", "block", "first", before.alias("before"), number.alias("file_no"))
    return lines.join(placed, ["file", "block"]).select("file", "file_no", (F.col("at") - F.col("first") + F.col("before")).alias("line_no"), "value")


def framed(lines: DataFrame, size: int, names: dict[int, str]) -> DataFrame:
    """file, file_no, rec_idx and the named lines of each record of ``size`` lines; a record that the file's end cuts off is left out.

    Lines of a record meet by an aggregate whose partial step does nearly all the work.
    """
    place = F.col("line_no") % size
    grouped = lines.groupBy("file", "file_no", F.floor(F.col("line_no") / size).alias("rec_idx"))
    values = [F.max(F.when(place == i, F.col("value"))).alias(name) for i, name in names.items()]
    return grouped.agg(*values, F.count("*").alias("lines")).filter(F.col("lines") == size).drop("lines")
