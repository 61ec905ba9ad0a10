"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node near it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    near = both.join(low, "u").where("v > u")
    return near.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges have u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge and isn't itself its component's smallest.

    ``edges`` has two columns of one type; loops and repeated edges don't matter.
    Each round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest chain.
    """
    a, b = edges.columns
    start = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    now, seen = store(start.distinct(), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = tuple(state)
        now = store(_small_star(_large_star(now)), "edges")
