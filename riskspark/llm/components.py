"""Connected components of a set of links, by alternating large-star and
small-star steps: every step joins links to the smallest neighbour of a node,
and a few steps leave a star around each component's smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.shared import stage


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours.  ~ hides an earlier
    partitioning, so that a hot node is combined before the shuffle."""
    least = pairs.groupBy(F.bitwise_not("u").alias("x")).agg(F.min("v").alias("m"))
    return least.select(F.bitwise_not("x").alias("u"), F.least("m", F.bitwise_not("x")).alias("m"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (a, b); the component is
    its smallest node."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(
        "u <> v").distinct(), "components-edges")
    mark = None
    while True:
        # large star: neighbours above a node move to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its neighbours below move to the smallest of them
        below = stage(large, "components-large")
        joined = below.join(_smallest(below), "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stage(small, "components-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now
