"""Connected components of an edge table by alternating star contractions.

Large star: every node links its larger neighbours to the smallest node it knows. Small
star: it links its smaller neighbours and itself to that node. Both keep the components and
shrink their depth until every node has one edge, to its component's smallest node. Minima
are combined before the shuffle, so a node with very many links is no problem; each
iteration is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkwell.llm.common import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node points at one node that points at none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return nodes.where("child > 1 or (child = 1 and parent = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a long, b long) that is not its component's smallest node.

    Self links and repeated links do not matter; an empty table has an empty result.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(edges):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = large.join(small, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = written(edges.where("a <> b").distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
