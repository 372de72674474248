"""Connected components of a table of links, by alternating large-star and small-star rounds.

Both kinds of round replace a node's links by links to the smallest node it knows; after O(log^2) rounds every
component is a star around its smallest node.  The minimum of a node's neighbours is aggregated before the shuffle, so a
node with very many links costs no more than others; joins on it are dealt out anew by adaptive execution.
Every round is written to the shared folder; only its row count and checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, store


FILE_LINKS = 200_000


def _print(df: DataFrame) -> tuple:
    """Row count and an order-free checksum."""
    return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def _star(directed: DataFrame, large: bool) -> DataFrame:
    """``directed`` holds (a, b) with b a neighbour of a."""
    least = directed.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    with_least = directed.join(least, "a")
    if large:
        return with_least.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.filter("a <> m").select("a", F.col("m").alias("b"))
    return with_least.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)


def connected_components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, its smallest id, of every id in ``links`` (a, b); ids without links are not listed."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, path = store(edges, "links")
    seen = _print(edges)
    while True:  # every round that changes anything lowers a label, so this ends
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, True).distinct()
        small = _star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False)
        # A round has no more links than the one before, so its files need not be more than these take.
        new, new_path = store(small.filter("a <> b").distinct().coalesce(seen[0] // FILE_LINKS + 2), "links")
        now = _print(new)
        drop(edges.sparkSession, path)
        edges, path = new, new_path
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
