"""Connected components by alternating stars, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v.

    Large: every neighbour above a node moves to the node's least neighbour.
    Small: every neighbour below it, and the node, do.
    """
    if large:
        edges = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = edges.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges`` (a, b).

    The component is its least node.  Nulls and loops are ignored.  Each round
    is a few joins and grouped minima over the edge list, written to the shared
    folder; the number of rounds grows with the logarithm of the longest path.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        now = materialize(_stars(_stars(now, True), False), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
