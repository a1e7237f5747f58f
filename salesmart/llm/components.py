"""Connected components of a link table: large-star and small-star rounds until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialize


def _low(edges: DataFrame) -> DataFrame:
    """Each u's smallest v, combined before the shuffle. The rebalance keeps a join from reusing the aggregate's
    dealing: both sides get an exchange of the join's own, so AQE can split a node with very many links."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).hint("rebalance")


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _low(both).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.distinct()
    low = _low(large)
    small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node but the roots: root is the smallest node reachable.

    ``edges`` has columns u and v. Each round's links go to the shared checkpoint folder; only their
    count and checksum reach the driver.
    """
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                                      F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        edges = materialize(_stars(edges))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
