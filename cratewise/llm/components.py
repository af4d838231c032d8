"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.operators.skew import splittable
from cratewise.session import checkpointed


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of its neighbours and itself."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    return (
        both.where("b > a")
        .join(splittable(least), "a")
        .select(F.col("b").alias("a"), F.col("root").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(splittable(least), "a").where("b > root")
    return least.select("a", F.col("root").alias("b")).unionByName(
        moved.select(F.col("b").alias("a"), F.col("root").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node reached.

    Ends when every edge leads from a node, that has no other, to a root, that has none. Edges
    from a node to itself say nothing; repeated ones count once.
    """
    edges = edges.where("a != b")
    done = False
    while not done:
        edges = checkpointed(_small_star(_large_star(edges)).distinct())
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        ends = ends.unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        unsettled = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        done = unsettled.where("out > 1 or out > 0 and into > 0").isEmpty()
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)
