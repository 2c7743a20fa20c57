"""Connected components of an edge table, by alternating large and small stars.

Every round is joins and grouped minima over the edges and ends in a reliable checkpoint. A hub is no
group of its own in any task: minima combine before the shuffle, and the join that brings a minimum
to the edges of its node has one row per node on one side, so adaptive execution can split the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import pin


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge in columns `a` and `b`; a component is named by its
    smallest node. Loops and null ends are no edges, repeated edges count once."""
    edges = pin(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(edges)
    while True:
        edges = pin(_stars(edges))
        before, state = state, _state(edges)
        if before == state:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
