"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.sources.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.filter("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"),
            F.bit_xor(F.xxhash64("a", "b")),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
        ).first()
    )


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, label)`` for every node that has a link; ``label`` is its smallest node.

    ``links`` may repeat pairs, hold them either way round, or link a node to itself; a null
    end is no link. Each round is written, so lineage stays short, and every step is a join or
    an aggregate that combines before its shuffle: a hub's neighbours never meet in one task.
    The number of rounds grows with the logarithm of the longest path.
    """
    ends = links.select(F.col(left).alias("x"), F.col(right).alias("y")).dropna()
    edges = ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    edges = stage(edges.filter("a > b").distinct(), "links")
    before = _mark(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "stars")
        now = _mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
