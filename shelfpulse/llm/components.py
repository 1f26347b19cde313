"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal for equal sets."""
    hashes = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashes)).first())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Of edges (a, b): every node from which a smaller one is reachable, with the smallest.

    Alternating stars: every node links its larger neighbours to its smallest one, then every
    node its smaller neighbours to the smallest. Rounds grow with the logarithm of the longest
    path and end when nothing changes. Only two numbers a round reach the driver. Nulls and
    loops are left out.
    """
    up, down = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    state = scratch.table(edges.select(up, down).distinct(), "edges")
    seen = _signature(state)
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = scratch.table(large.distinct(), "large-star")
        scratch.discard(state)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), "m")
        small = moved.unionByName(least).select("u", F.col("m").alias("v"))
        state = scratch.table(small.distinct(), "small-star")
        scratch.discard(large)
        now = _signature(state)
        if now == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
