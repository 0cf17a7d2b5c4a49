"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import written


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest of its neighbourhood."""
    near = both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("_least"))
    return near.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("_least").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_least"))
    moved = down.join(least, "a").where("b != _least").select(
        F.col("b").alias("a"), F.col("_least").alias("b"))
    return moved.unionByName(least.select("a", F.col("_least").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node it reaches, for all nodes of links (a, b).

    A node with many links is a key with many rows, which are only counted for
    their least value and joined to one row. Each round is stored; the rounds grow
    as the logarithm of the longest chain. Links of a node with itself are left out.
    """
    edges = written(edges.where("a != b").select("a", "b").distinct(), "links")
    known = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                          ).first()
        if state == known or not state[0]:
            break
        known = state
        edges = written(small_star(large_star(edges)).where("a != b").distinct(), "links")
    tips = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return tips.unionByName(tips.select(F.col("component").alias("node"), "component").distinct())
