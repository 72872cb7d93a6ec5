"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veclode.llm.common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).head())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node moves to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("least").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every lesser neighbour of a node, and the node, move to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    moved = edges.join(least, "b").where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("least").alias("a"), "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b, any ordered type); the root
    is the least node that can be reached, itself included. Loops and repeats do no harm.

    The edges of each round are a stored table; rounds end when it stays as it was, after
    about the logarithm of the longest path.
    """
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = stored(ordered.distinct())
    was, mark = None, _fingerprint(now)
    while mark != was:
        now = stored(_small_star(_large_star(now).distinct()).distinct())
        was, mark = mark, _fingerprint(now)
    loops = edges.where("a = b").select("a").distinct().select("a", F.col("a").alias("b"))
    nodes = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    found = nodes.unionByName(roots)
    alone = loops.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(alone.join(found, "node", "left_anti"))
