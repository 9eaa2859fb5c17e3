"""Connected components of a graph given as edges, by repeated minima and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.operators.sizing import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node reachable.

    Each round hangs every root on the smallest root among its neighbours' and then
    halves all paths; the edges between roots shrink until none is left, in a number of
    rounds that grows with the logarithm of the longest path.  Rounds are written tables.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a != b")
    links = written(both.distinct(), "cc-links")
    nodes = written(links.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "cc-roots")
    while not links.isEmpty():
        best = links.groupBy("a").agg(F.min("b").alias("b"))
        hung = written(best.select("a", F.least("a", "b").alias("root")), "cc-hung")
        hung = _jumped(hung)
        nodes = written(
            nodes.join(hung.select(F.col("a").alias("root"), F.col("root").alias("up")), "root", "left")
            .select("node", F.coalesce("up", "root").alias("root")), "cc-roots",
        )
        left, right = hung.toDF("a", "ra"), hung.toDF("b", "rb")
        between = links.join(left, "a").join(right, "b").filter("ra != rb")
        links = written(between.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-links")
    return nodes


def _jumped(parents: DataFrame) -> DataFrame:
    """Parents (a, root) with every path cut to its end; a parent is never larger than its child."""
    while True:
        up = parents.select(F.col("a").alias("root"), F.col("root").alias("up"))
        step = written(
            parents.join(up, "root").select("a", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")),
            "cc-jump",
        )
        parents = step.select("a", "root")
        if step.filter("moved").isEmpty():
            return parents
