"""Operator 5: allow and block rules on URLs by a sort-merge range join.

A rule's reversed host and path are a key, and the keys that start with it an
interval. A URL asks once for its host and for each parent domain. Distinct keys
are dealt to ranges, each rule to the ranges it reaches into, and a sorted sweep
of each range keeps a stack of the nested rules that are open.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.arrow import as_bytes
from readloom.llm.scratch import Scratch

#: Sampled keys for each range.
KEYS_PER_RANGE = 100


def lower_ascii(column: Column) -> Column:
    return F.translate(column, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column, path: Column) -> Column:
    """Labels from the last to the first, a slash (no host holds one), the path."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("/"), path)


def parents(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def range_bounds(keys: DataFrame) -> list[str]:
    """Keys that cut the table into as many ranges as shuffle partitions, from a bounded sample."""
    ranges = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    there = keys.count()
    share = min(1.0, ranges * KEYS_PER_RANGE / max(1, there))
    sample = sorted(r[0].encode() for r in keys.sample(share, 17).limit(4 * ranges * KEYS_PER_RANGE).collect())
    step = max(1, len(sample) // ranges)
    return [k.decode() for k in dict.fromkeys(sample[step::step])]


def sweep(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """key, rule, verdict of the longest rule whose interval holds each distinct key that has one.

    ``keys``: key; ``rules``: key, rule, verdict.
    """
    bounds = F.array(*map(F.lit, range_bounds(keys))).cast("array<string>")

    def swept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[bytes, str, str]] = []
        now = None
        for batch in batches:
            found = []
            for at, key, rule, verdict in zip(batch["range"].to_pylist(), as_bytes(batch["key"]), batch["rule"].to_pylist(), batch["verdict"].to_pylist(), strict=True):
                if at != now:
                    stack, now = [], at
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule is not None:
                    stack.append((key, rule, verdict))
                elif stack:
                    found.append((key.decode(), *stack[-1][1:]))
            yield pa.RecordBatch.from_pylist([dict(zip(("key", "rule", "verdict"), x, strict=True)) for x in found], schema=pa.schema([(n, pa.string()) for n in ("key", "rule", "verdict")]))

    first = F.size(F.filter(bounds, lambda b: b <= F.col("key")))
    last = F.size(F.filter(bounds, lambda b: (b <= F.col("key")) | b.startswith(F.col("key"))))
    asked = keys.select(first.alias("range"), "key", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    dealt = rules.select(F.explode(F.sequence(first, last)).alias("range"), "key", "rule", "verdict")
    laid = asked.union(dealt).repartition("range").sortWithinPartitions("range", "key", F.col("rule").isNull())
    return laid.mapInArrow(swept, "key string, rule string, verdict string")


def judge_urls(pages: DataFrame, rules: DataFrame, *, otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, host, path, rule and verdict of every row.

    ``rules``: host, path, verdict (allow or block). A rule fits its host and
    all subdomains if the URL's path starts with its path; the longest (host and
    path together) wins, then block; without one, ``otherwise``. A null URL, or
    one without ``://``, has an empty host and path and fits no rule. Rules with
    a null host or path are skipped, of repeated ones block wins. Repeated rows
    give repeated results; empty tables are fine; other columns are not read.
    """
    scratch = Scratch(pages.sparkSession)
    judged = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col).cast("string")).alias("host"), path_of(F.col(url_col).cast("string")).alias("path"))
    pairs = judged.select("host", "path").filter("host <> ''").distinct()
    asked = scratch.keep(pairs.withColumn("parent", F.explode(parents(F.col("host")))).select("host", "path", key_of(F.col("parent"), F.col("path")).alias("key")))
    hosts = rules.select(lower_ascii("host").alias("host"), "path", "verdict").dropna(subset=["host", "path"])
    once = hosts.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    keyed = once.select(key_of(F.col("host"), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "verdict")
    matched = sweep(asked.select("key").distinct(), keyed)
    ranked = F.max(F.struct(F.length("rule"), "verdict", "rule"))
    best = asked.join(matched, "key").groupBy("host", "path").agg(ranked.alias("best")).select("host", "path", "best.rule", "best.verdict")
    out = judged.join(best, ["host", "path"], "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
