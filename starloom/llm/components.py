"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..scratch import materialize

MOST_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node that has an edge.

    Each round hangs the larger neighbours of a node below its smallest
    neighbour, then does the same with the smaller ones, until stars remain.  A round
    stores its edges twice, so nothing is recomputed, and edges that are stars already
    cost one look at them.  A node's neighbours are never gathered: each half of a
    round takes a minimum per node (combined before the shuffle) and joins it.
    """
    now = materialize(
        edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).filter("x <> y").distinct(), "edges"
    )
    for _ in range(MOST_ROUNDS):
        if _are_stars(now):
            break
        up = now.select(F.col("y").alias("x"), F.col("x").alias("y"))
        low = now.unionByName(up).groupBy("x").agg(F.min("y").alias("low")).withColumn("low", F.least("x", "low"))
        # The node itself hangs below its smallest neighbour too.
        large = materialize(_hang(up, low), "large")
        least = large.groupBy("x").agg(F.min("y").alias("low"))
        now = materialize(_hang(large, least).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("y").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(roots)


def _hang(edges: DataFrame, low: DataFrame) -> DataFrame:
    """The neighbours ``y`` of each ``x``, and ``x`` itself, below the smallest."""
    moved = edges.join(low, "x").select(F.col("y").alias("x"), F.col("low").alias("y"))
    return moved.unionByName(low.select("x", F.col("low").alias("y"))).filter("x <> y")


def _are_stars(edges: DataFrame) -> bool:
    """Does every node hang below one node that hangs below none?"""
    ends = edges.select(F.col("x").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("y").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return ends.filter("below > 1 or (below = 1 and above = 1)").agg(F.count(F.lit(1))).first()[0] == 0
