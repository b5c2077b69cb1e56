"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger neighbours (or itself and its smaller ones) on the smallest node it knows."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if large:
        return hung
    return hung.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``u, v``; a component is named by its smallest node.

    Every step is written, so that a lost executor costs one step. The steps end when all edges point at the
    smallest node, after about the logarithm of a component's width.
    """
    now = edges.select("u", "v").where("u <> v")
    mark = None
    while True:
        now = store(_star(_star(now, large=True), large=False))
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if state == mark:
            break
        mark = state
    rooted = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return rooted.union(rooted.select(F.col("component").alias("node"), "component").distinct())
