"""Connected components of a table of edges, by alternating large and small stars.

Every round hangs each node's larger neighbours, then its smaller ones, on the smallest one it knows, until all
edges point at the smallest node of their component. A round is two joins and aggregates over the edges; it is
written to the shared folder, so that no lineage grows and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.staging import written


def _state(edges: DataFrame):
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node of its component."""
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = edges.where("a != b").select(larger.alias("a"), smaller.alias("b")).distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "edges-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(least).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
