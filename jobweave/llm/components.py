"""Connected components of an edge table, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of `edges` (a, b: of one orderable type): the smallest node reachable.

    Alternates the large-star and small-star steps: each node's larger, then smaller neighbours move to
    its smallest one, until every edge is a star around a root. The number of rounds grows with the
    logarithm of a component's size. A node with very many neighbours is aggregated in parts before the
    shuffle and joined, never gathered. Each round is written to the shared folder. Null ends are dropped.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "star"
    )
    while True:
        # Large star: every larger neighbour of a node moves to the smallest of the node and its neighbours.
        both = now.select("v", "u").unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"), F.col("m").alias("u"))
        then = written(small.where("u <> v").distinct(), "star")
        if _signature(now) == _signature(then):
            return then.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                then.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        now = then


def _signature(edges: DataFrame) -> tuple:
    """Count and order-free hashes of the edges: two rounds with equal ones hold the same edges."""
    h = F.xxhash64("v", "u")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum((h.bitwiseAND(F.lit(0xFFFFFFFF))))).first())
