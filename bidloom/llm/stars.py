"""Connected components of a distributed edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for each node of `edges(a long, b long)` but the roots.

    Each step replaces edges by edges to the smallest neighbour, with map-side minima and joins in which one side has a row a
    node, so that adaptive execution can split a node with very many edges. The number of steps grows with the logarithm of
    the size of a component. Edge lists are written between the steps; nothing but a count and a checksum reaches the driver.
    """
    edges = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while True:
        edges = materialise(_small(_large(edges)), "links")
        after = _state(edges)
        if after == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = after


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets an edge to the smallest node around it. Edges go from larger to smaller."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get edges to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
