"""Connected components of a graph of links, by stars.

Each round hangs the neighbours of a node below the least of them, first the
larger ones (large star), then the smaller ones (small star), until every edge
leads from a node to the least node of its component. The edges of a round are
written to the shared folder, so that the next round's joins are planned from
real sizes and nothing is computed again when an executor is lost. A node's
neighbours are never gathered: joins and combinable minima only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.storage import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for each node with an edge; ``root`` is the least node that it reaches.

    Nulls, loops, repeated edges and both directions of an edge are allowed.
    """
    current = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = cut_lineage(current.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "edges")
    while not _stars(current):
        current = cut_lineage(_small_star(_large_star(current)), "edges")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u").filter(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Does every node hang below one node that hangs below none?"""
    several = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
    chained = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return several.select("u").unionByName(chained).isEmpty()
