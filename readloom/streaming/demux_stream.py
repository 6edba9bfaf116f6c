"""Demultiplexing of read pairs as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from readloom.operators.demux import demux_pairs
from readloom.plans.layout import Layout

PAIR_SCHEMA = "rec_idx long, name_f string, seq_f string, qual_f string, name_r string, seq_r string, qual_r string"


def demux_stream(spark: SparkSession, source: str, samples: DataFrame, layout: Layout, max_mismatch: int = 1) -> DataFrame:
    """A stream of the parquet pairs in a folder, demultiplexed; each read stands alone, so there is no state.

    The sample sheet, at most as many rows as there are barcodes, is read once.
    """
    samples = spark.createDataFrame(samples.collect(), samples.schema)
    return demux_pairs(spark.readStream.schema(PAIR_SCHEMA).parquet(source), samples, layout, max_mismatch)


def write_stream(reads: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends what has arrived, by sample and replicate, and stops."""
    named = reads.withColumn("replicate", F.coalesce("replicate", F.lit("none")))
    return named.writeStream.format("parquet").partitionBy("sample", "replicate").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def count_stream(reads: DataFrame, table: str) -> StreamingQuery:
    """Running counts by sample, replicate and outcome in an in-memory table; the state has a row for each."""
    counts = reads.groupBy("sample", "replicate", "outcome").count()
    return counts.writeStream.format("memory").queryName(table).outputMode("complete").trigger(availableNow=True).start()
