"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Every neighbour of a node is tied to the least of the node and its neighbours; small: only neighbours below the node count, else only those above move."""
    ways = _both_ways(edges)
    ways = ways.where("b < a") if small else ways
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")).withColumnRenamed("a", "node")
    moved = ways.join(least, F.col("a") == F.col("node"))
    if small:
        # the node itself goes to its least neighbour too
        moved = moved.select(F.col("b").alias("v"), "least").unionByName(least.select(F.col("node").alias("v"), "least"))
    else:
        moved = moved.where("b > a").select(F.col("b").alias("v"), "least")
    return moved.where("v != least").select(F.col("least").alias("a"), F.col("v").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (root, node) are stars: every node has one root, and no root is a node of another."""
    tops = edges.select(F.col("a").alias("v"), F.lit(1).alias("top"), F.lit(0).alias("under")).distinct()
    nodes = tops.unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("top"), F.lit(1).alias("under")))
    return nodes.groupBy("v").agg(F.sum("top").alias("top"), F.sum("under").alias("under")).where("under > 1 or (top > 0 and under > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of edges (a, b) the least node of its component.

    Alternating large and small stars until the edges are stars; each round works on a written table, joins only on a node and
    never brings a component together. Self loops are ignored.
    """
    now = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "stars")
    while not _settled(now):
        now = materialise(_stars(_stars(now, small=False), small=True), "stars")
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
