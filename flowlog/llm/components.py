"""Connected components of an edge table by alternating star operations, a written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlog.llm.storage import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).collect()[0])


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges (u, v)``: the smallest node of its component.

    Ends when a round changes nothing, after a number of rounds that grows with the logarithm of the
    longest path. Every round is a written table, so a lost executor repeats one round at most. A node
    with very many neighbours is reduced on the map side first, and only its edges are dealt out again.
    """
    edges = edges.where("u <> v").select("u", "v").distinct()
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)).distinct(), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
