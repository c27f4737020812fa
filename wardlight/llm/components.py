"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.session import cut_lineage


def _large_stars(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest node it knows to its larger neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_stars(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of integers: (node, root), root the smallest node of the component.

    Nodes without an edge to another node are not listed. Groups are reduced by joins and
    partial minima only, so a node with very many neighbours is never held in one place. The
    rounds grow with the logarithm of the longest path. Nulls and self-loops are ignored.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = cut_lineage(edges)
    before = _mark(edges)
    while before[0]:
        edges = cut_lineage(_small_stars(cut_lineage(_large_stars(edges).distinct())).distinct())
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
