"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for each node with a link.

    Alternates two steps until all is stars, each node linked with the smallest of its component
    only: every node hands the smallest of its neighbours to its larger ones, then to its smaller
    ones. Each step is an aggregation and a join by node; no
    neighbour list is collected, so a node with very many links is no special case.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    pairs = saved(pairs, "components")
    while not _only_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        smaller = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smaller, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smaller.select("u", F.col("m").alias("v")))
        pairs = saved(small.distinct(), "components")
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return saved(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct(), "components")


def _only_stars(pairs: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or both a smaller and a larger one."""
    sides = pairs.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    ends = sides.groupBy("node").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return ends.where("down > 1 or down > 0 and up > 0").isEmpty()
