"""Connected components of a graph given by its edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _toward_least(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with m, the least v of each u. The minima are staged so that a join with a hub's pairs can be split."""
    least = stage(pairs.groupBy("u").agg(F.min("v").alias("m")))
    return pairs.join(least, "u")


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that an edge joins to another; root is the least node of its component."""
    one, two = F.col(a), F.col(b)
    star = stage(edges.filter(one != two).select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v")).distinct())
    before = None
    while True:
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _toward_least(both).withColumn("m", F.least("u", "m"))
        large = stage(near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = _toward_least(large)
        small = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stage(small.unionByName(near.select("u", F.col("m").alias("v"))).distinct())
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
