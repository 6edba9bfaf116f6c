"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch


def connected(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that each node of ``edges`` (a, b) reaches.

    A large star hangs the larger neighbours of each node on its smallest
    neighbour, a small star does so with the smaller ones; both keep components
    and number a logarithm of the nodes. Minima are pre-aggregated, and the join
    that spreads them has one row per node on one side, so a hub is split.
    """
    now = scratch.keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = scratch.keep(small)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
