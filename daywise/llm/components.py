"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node below the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("least"))
    moved = both.filter("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours below the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    siblings = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), "least")
    return siblings.union(least).select("a", F.col("least").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; `root` is the least node it can reach.

    `edges` has two columns of one type in any order; loops, nulls and repeated edges do no harm.
    Each round is written to the shared folder, so lineage stays short and a lost executor costs
    a re-read. The number of rounds grows with the square of the logarithm of the longest path at
    most. A hub's edges are joined with one row, which adaptive execution splits.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    edges = materialise(edges, "edges")
    state = _state(edges)
    while state[0]:
        edges = materialise(_small_star(_large_star(edges)), "stars")
        known, state = state, _state(edges)
        if state == known:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
