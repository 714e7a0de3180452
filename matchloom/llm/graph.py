"""Distributed connected components: alternating large-star and small-star contraction, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. large: every node's greater neighbours move to its least neighbour; else the lesser ones do.

    The least neighbour comes from a partial aggregate, and only the join back sees a hub's edges together; Spark
    splits such a join's hot partitions, and nothing gathers a hub's neighbours in one row.
    """
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    both = near.join(least, "u")
    moved = both.filter(F.col("v") > F.col("u")) if large else both
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def _done(edges: DataFrame) -> bool:
    """Whether edges (greater to lesser node) are stars: no node has two edges down, and none that has one is led to."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(edges: DataFrame, left: str = "u", right: str = "v", label: str = "cc") -> DataFrame:
    """(node, root) for every node of an edge; root is the least node of its component. Nodes: any orderable type.

    Null ends and loops: dropped (a node with nothing but loops doesn't appear). Repeated edges count once. No edge: no row.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u is not null and v is not null and u != v").distinct()
    e = written(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    while not _done(e):
        before, e = e, written(_star(_star(e, True), False), label)
        drop(before)
    # every edge leads from a node to its root
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v"))).distinct()
