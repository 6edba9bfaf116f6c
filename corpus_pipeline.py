"""Corpus preparation: documents through quality rules, near-duplicate removal, decontamination, redaction and packing.

Each stage takes all documents that the one before kept; all but the last
return the columns of ``documents``. Rows are told apart by all their columns, so
rows without a doc_id and different rows of one doc_id go through every
stage; only rows that are equal in all columns are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.contamination import contained_items
from readloom.llm.jaccard_join import FEW, near_duplicates
from readloom.llm.line_rules import quality_rules
from readloom.llm.packing import pack
from readloom.llm.pii import find_personal_data
from readloom.llm.queries import PIECE_COLUMNS, TOKENIZER, table
from readloom.llm.scratch import Scratch

#: Words that a packing task remembers; fewer than by default, since its executors have the other stages' memory too.
REMEMBERED = 300_000
#: The name of the key that tells rows apart within a stage.
KEY = "row_key_of_stage"


def with_text(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` around a new text; ``changed`` has them, but text and n_chars, in ``row``."""
    columns = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return changed.select(*(columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def as_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*(c for c in docs.columns if c not in ("text", "n_chars"))).alias("row"), "text")


def keyed(docs: DataFrame) -> DataFrame:
    """With a hash of all columns."""
    return docs.withColumn(KEY, F.xxhash64(*docs.columns))


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``keyed`` rows but those of ``keys``, without the key; a short list goes to every task, a long one is joined by a shuffle."""
    keys = Scratch(rows.sparkSession).keep(keys.select(KEY).distinct())
    return rows.join(F.broadcast(keys) if keys.count() <= FEW else keys, KEY, "left_anti").drop(KEY)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules(as_rows(docs), id_col="row")
    return with_text(docs, judged.filter("kept"), "clean_text")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the least doc_id stays, and of several the one with the least key."""
    scratch, rows = Scratch(spark), keyed(docs)
    groups = scratch.keep(near_duplicates(rows, id_col=KEY).select(KEY, "component_id"))
    others = groups.filter(F.col(KEY) != F.col("component_id"))
    grouped = scratch.keep(others.union(others.select(F.col("component_id").alias(KEY), "component_id")).distinct())
    few = F.broadcast(grouped) if grouped.count() <= FEW else grouped
    members = rows.select(KEY, "doc_id").join(few, KEY).select(KEY, "component_id", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", KEY).alias("own"))
    members = scratch.keep(members)
    least = members.groupBy("component_id").agg(F.min("own").alias("least"))
    least = scratch.keep(least.select("component_id", F.col("least")[KEY].alias("stays")))
    gone = members.join(F.broadcast(least) if least.count() <= FEW else least, "component_id").filter(F.col(KEY) != F.col("stays"))
    kept = without(rows, gone)
    repeated = groups.groupBy(KEY).count().filter("count > 1").limit(1).count()
    return kept.dropDuplicates() if repeated else kept


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(docs)
    return without(rows, contained_items(rows, table(spark, sf_dir, "benchmark"), id_col=KEY))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_text(docs, find_personal_data(as_rows(docs), id_col="row"), "redacted")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, TOKENIZER, remembered=REMEMBERED).select(*PIECE_COLUMNS)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", one_of_each),
    ("decontamination", decontaminated),
    ("pii", private),
    ("packing", packed),
]
#: Trees, tokenizers and rules over lines are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each one's result written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
