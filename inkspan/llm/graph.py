"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b); the root is the smallest node.

    Each round points the neighbours of a node to the smallest node it knows, first
    the larger neighbours, then the smaller ones. The number of rounds grows with
    the logarithm of the nodes. Every round is a written table, joins go by node
    and the neighbours of one are never gathered, so a hub is only a long join key.
    """
    now = written(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    met = both.join(least, "a").where("b > a")
    return met.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    met = edges.join(least, "a").where("b != least")
    return met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b"))
    ).distinct()
