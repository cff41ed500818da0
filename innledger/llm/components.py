"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for the nodes of ``edges``.

    ``edges`` has the long columns ``a`` and ``b``; direction and repetition do not matter.
    Every round points the larger neighbours of each node at its smallest one, then each
    node and its smaller neighbours at their smallest (large and small stars), and stores
    the edges; after about the logarithm of the longest path, squared, all point at the
    smallest node. Neighbours are never gathered: a node with very many is a join key that
    adaptive execution splits.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stored(edges.select(larger, smaller).filter("a != b").distinct(), "edges")
    before = None
    while (state := _state(now)) != before and state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), "m")
        large = large.filter("a != m").distinct().withColumnRenamed("m", "b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), "m")
        small = small.unionByName(least).withColumnRenamed("m", "b").distinct()
        now, before = stored(small, "edges"), state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """A digest of the edges that no round leaves unchanged unless it changed nothing."""
    return tuple(
        edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )
