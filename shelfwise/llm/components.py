"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import discard, keep


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for every node of ``edges`` (``a``, ``b``).

    Each step joins nodes to the minimum of their neighbourhood, an
    aggregate with partial sums, so that a node with very many neighbours
    is not one task's work.  Ends when a step changes nothing.
    """
    now = keep(_clean(edges.select("a", "b")), "edges")
    seen = _digest(now)
    while True:
        # large star: larger neighbours move to the smallest node near
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours move to the smallest of them
        large = keep(_clean(large), "large-star")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        before, now = now, keep(_clean(small), "small-star")
        discard(before, large)
        digest = _digest(now)
        if digest == seen:
            break
        seen = digest
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, larger end first, no loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
