"""Connected components of an edge list, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; no component, link list or label is collected. The steps' tables
are written to the shared folder, so lineage stays short and lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import sole, stored


def _sum(edges: DataFrame) -> tuple[int, int]:
    """Count and an order-free hash sum of the edges, to see that nothing changes any more."""
    return tuple(sole(edges.agg(F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.lit(0)))))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (u, v); root is the smallest node of its component.

    Loops, repeated and reversed edges are allowed; an empty list gives no rows.
    """
    edges = edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.distinct(), "edges")
    seen = _sum(edges)
    while seen[0]:
        # Large star: every neighbour above a node is linked to the smallest of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: every neighbour below a node, and the node, are linked to the smallest of them.
        large = stored(large.where("u <> v").distinct(), "large-star")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = _sum(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
