"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from readloom.llm.arrow import small_batches


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a local session without that setting gets a temporary one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="spark-readloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/readloom-{uuid.uuid4().hex}"


class Scratch:
    """Writes tables that are read more than once, which also cuts their lineage."""

    def __init__(self, spark: SparkSession):
        small_batches(spark)
        self.spark, self.top, self.n = spark, folder(spark), 0
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.top}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path
        return kept

    def release(self, kept: DataFrame) -> None:
        """Frees the disk of a kept table that nothing reads any more; an empty one takes its place."""
        self.spark.createDataFrame([], kept.schema).write.mode("overwrite").parquet(self.paths.pop(id(kept)))
