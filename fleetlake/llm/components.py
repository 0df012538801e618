"""Connected components of an edge table by alternating large-star and small-star rounds.

Nodes are longs; the result maps every node of the table to the smallest node
it reaches.  A round is two joins on the node; the number of rounds grows with
the logarithm of the longest chain.  Nothing is collected but two numbers per
round, and every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where("v > u and v <> m")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs, any direction, loops and repeats allowed -> ``(node, component_id)``
    for every node with an edge to another node; nulls are ignored."""
    now = written(edges.where("a is not null and b is not null and a <> b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(now)
    while before[0]:
        now = written(_small_star(_large_star(now)), "edges")
        after = _mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct())
