"""Connected components by alternating large and small stars.

Each round is joins and aggregates whose sizes follow the links; a node with very
many links is the hot side of an ordinary join, which Spark can split. Every round
is written to the shared folder, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (``a``, ``b``) that is linked to
    another one; the root is the least node of its component, and no node of its own."""
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(links.where("a <> b").select(high, low).distinct(), "links")
    before, now = None, checksum(edges)
    while now != before:
        # Large star: neighbours above a node go to the least of its neighbours.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its neighbours below go to the least of them.
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), "m")
        edges = stage(small.union(below).distinct().toDF("a", "b"), "stars")
        before, now = now, checksum(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def checksum(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())
