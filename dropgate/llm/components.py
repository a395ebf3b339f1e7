"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the component's least node.

    Alternating large-star and small-star rounds: each node's larger
    neighbours, then its smaller ones, are linked to the least of them, until
    the edges are stars (every node but a center has one edge, to its center).
    A round is two aggregations and joins on the node; the joined side has one
    row per node, so a node with very many edges can be split. The edge set is
    written after each round.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "cc-edges")
    while not _stars(e):
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lower.select("a", F.col("m").alias("b"))).distinct())
        e = written(small, "cc-edges")
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def _stars(e: DataFrame) -> bool:
    """Whether no node has two edges down and no center has one."""
    more = e.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    return more.isEmpty() and e.select(F.col("b").alias("a")).join(e.select("a"), "a", "left_semi").isEmpty()
