"""Connected components of an undirected graph given as edges.

Each round links every node to the least node of its neighbourhood (large star, then small
star), which keeps connectivity and halves distances; after some log n rounds every node
points at the least node of its component. Rounds end in a table in the shared folder, and
only a row count returns to the driver. A hub's edges are split by adaptive skew joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (a, b) with a > b."""
    if large:  # neighbours above a node go to the least neighbour
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # neighbours below a node, and itself, go to the least
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node with an edge to a smaller one, the least reachable.

    ``edges`` has columns a and b; loops and copies do no harm. Nodes that are the least of
    their component have no row.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(now.where("a > b").distinct(), "edges")
    while True:
        new = stored(_star(_star(now, True), False), "edges")
        same = new.count() == now.count() and new.join(now, ["a", "b"], "left_anti").isEmpty()
        now = new
        if same:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
