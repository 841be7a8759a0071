"""Connected components of a graph given as edges, by alternating stars.

Each round links every vertex's larger neighbours to its smallest one (large star), then
every vertex's smaller neighbours to their smallest (small star), until nothing changes; the
edges then link each vertex to the smallest of its component. Rounds grow with the logarithm
of the longest path. Each round is an aggregation and a join per star, written to the shared
folder, so no vertex, component or edge list is ever gathered, and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qadump.llm.common import staged, used_up

MOST_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    nearest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    smallest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """vertex, root (the smallest vertex of its component) for all vertices but the roots.

    edges: two long columns, a and b; loops and repeated edges are ignored.
    """
    graph = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    for _ in range(MOST_ROUNDS):
        state = graph.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return graph.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        before = state
        last, graph = graph, staged(_stars(graph), "stars")
        used_up(last)
    raise RuntimeError("components did not settle")
