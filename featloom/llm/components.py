"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; ``edges`` has u and v, the root is the smallest node.

    Each round joins edges with the minimum of their node, writes the new edges
    and stops when they no longer change: O(log nodes) rounds, no list of
    neighbours anywhere.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(ordered.distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
