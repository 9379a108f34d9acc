"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.plans.scratch import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component: its smallest node.

    Alternating large-star and small-star steps: every neighbourhood is reduced to its minimum by
    an aggregate (combined map-side, so a node with very many edges is no single task's load) and
    joined back.  The number of rounds grows with the logarithm of the longest path; the edges of
    each round are written to the shared folder, which also cuts the lineage.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # Large star: neighbours above a node move to the smallest one around it.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        moved = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = moved.where("a <> b").distinct()
        # Small star: the node and its lower neighbours move to the smallest of these.
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(lowest, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(joined.select("a", F.col("low").alias("b")))
        now = settle(small.where("a <> b").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
