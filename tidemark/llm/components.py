"""Connected components of an undirected graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (``a``, ``b``; long).

    Each round points all neighbours of a node at the smallest of them, first the larger ones, then
    the smaller ones with the node itself; the number of rounds grows with the logarithm of the longest path.
    Every round is written, so no lineage grows and no set of edges comes to the driver; a node with many
    neighbours is a partial minimum and a join, not a gathered list.  Loops and NULLs are left out.
    """
    held = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    held, before = written(held, "edges"), None
    while True:
        both = held.union(held.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = low.select("u", F.col("m").alias("v"))
        held = written(small.union(own).distinct(), "edges")
        state = held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(held.select("v", "v").distinct())
