"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import stored


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and an order-free checksum: equal marks mean equal edges."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"] or 0


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) for edges a, b of longs.

    A component's smallest node and nodes without an edge don't appear. Each round
    points every node at the smallest node it can see, with minima taken before rows are
    shuffled; the number of rounds grows with the logarithm of the longest path. The
    driver sees a count and a checksum per round.
    """
    linked = edges.where(F.col("a") != F.col("b"))
    ordered = linked.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(ordered.distinct(), "edges")
    mark = _mark(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = stored(large.distinct(), "large-stars")

        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = lowest.select("a", F.col("m").alias("b"))
        current = stored(moved.where("a <> b").union(kept).distinct(), "small-stars")
        now = _mark(current)
        if now == mark:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
