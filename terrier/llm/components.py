"""Connected components of a graph given as rows, by large-star and small-star steps.

Each round replaces edges by edges to the smallest neighbour (large-star: from larger neighbours;
small-star: from smaller ones), until every node hangs on the smallest node of its component. Rounds
grow with the logarithm of the component size; hubs are summed on the map side and their joins split
by the adaptive planner. Every round is written to the shared folder, so lineage stays short. Nothing
but the number of changed edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.filter("b > a").join(low, "a").select(F.col("low").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges run from the smaller ``a`` to the larger ``b``: the neighbours of ``b`` below it are its ``a``.
    low = edges.groupBy("b").agg(F.min("a").alias("low"))
    moved = edges.join(low, "b")
    return moved.select(F.col("low").alias("a"), "b").union(
        moved.filter("a != low").select(F.col("low").alias("a"), F.col("a").alias("b"))).distinct()


def components(*edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes that are not the smallest.

    Columns of ``edges`` are ``a`` and ``b``; loops, repeats and nulls are ignored.
    """
    parts = [e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .filter("a < b") for e in edges]
    current = parts[0]
    for part in parts[1:]:
        current = current.union(part)
    current = written(current.distinct(), "edges")
    while True:
        following = written(_small_star(_large_star(current)), "edges")
        changed = following.join(current, ["a", "b"], "left_anti").limit(1).count()
        done = not changed and following.count() == current.count()
        current = following
        if done:
            return current.select(F.col("b").alias("node"), F.col("a").alias("component"))
