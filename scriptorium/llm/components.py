"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node that can be reached.

    Each round lets every node point its larger neighbours (large star) and then its smaller ones (small
    star) at the smallest neighbour, until nothing moves; the number of rounds grows with the logarithm of
    the longest chain. Neighbour lists are never collected: a round is a minimum per node, combined before
    the shuffle, and a join. Rounds end in tables of the shared folder. Loops and repeated links are allowed.
    """
    edges = written(_down(links.select("a", "b")), "links")
    state = _state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _down(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """For edges a > b: every larger neighbour of a node points at the node's smallest neighbour or the node itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b"))
    return _down(moved)


def _small_star(edges: DataFrame) -> DataFrame:
    """For edges a > b: the smaller neighbours of a node and the node point at the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
