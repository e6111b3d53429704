"""Connected components of a graph given as pairs of ids, by stars.

Large-star and small-star steps (Kiveris et al., "Connected components in MapReduce and
beyond") alternate until every component is a star. Every step is an aggregate that
combines before the shuffle and a join that adaptive execution can split, so a node with a
third of all edges is not one task. Nothing but one answer per step reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import scratch


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least neighbour of u, or u itself if that is less."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    known = _with_least(edges)
    others = known.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(known.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent, and no parent has one itself."""
    child = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    parent = edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = child.union(parent).groupBy("node").agg(
        F.sum("up").alias("up"), F.max("down").alias("down")
    )
    return ends.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of bigint ids to ``node, component``; a component's id is its least node.

    Pairs with a null side or of a node with itself say nothing. Nodes without a pair are
    not in the result. Repeated pairs count once.
    """
    current = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    while True:
        current = scratch.staged(_small_star(_large_star(current)), "edges")
        scratch.release(edges.sparkSession)
        if _are_stars(current):
            break
    named = current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select("v", "v").distinct()
    )
    return scratch.staged(named, "components")
