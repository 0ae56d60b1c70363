"""Connected components of a graph given as a table of edges.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond"): each step links every vertex to the smallest of its
neighbours.  A vertex with very many edges costs one row per task in the
aggregation; the join back to its edges is one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with a > b.  Large star: each vertex's larger neighbours are
    linked to the smallest vertex around it.  Small star: its smaller ones and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("m"))
    near = both.join(least, both["a"] == least["v"]).select("a", "b", "m")
    if large:
        out = near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("v").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every vertex that is not the smallest of its
    component; ``edges``: two id columns, in either order."""
    x, y = edges.columns[:2]
    now = edges.filter(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    now = scratch.cut(now)
    while True:
        # In a finished star every b is a root: no a is a b, and every a has one b.
        moved = scratch.cut(_star(_star(now, large=True), large=False))
        left = moved.select(F.col("b").alias("a")).join(moved.select("a"), "a", "left_semi").isEmpty()
        twice = moved.groupBy("a").count().filter("count > 1").isEmpty()
        scratch.drop(now)
        now = moved
        if left and twice:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
