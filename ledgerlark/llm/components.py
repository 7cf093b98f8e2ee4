"""Connected components of an edge list by star contraction, all of it in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.lineage import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. Edges run from small a to large b."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    near = edges.join(least, "b").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return near.union(least.select(F.col("least").alias("a"), "b"))


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): the smallest node that can be reached (an action).

    Each round is written out, so lineage stays short. The rounds grow with the logarithm of the longest chain. Only a
    count and a checksum reach the driver. A loop edge or a repeated edge changes nothing; no edges give no rows.
    """
    edges, last = materialise(_ordered(edges), "edges"), None
    while True:
        edges = materialise(_ordered(_small_star(_ordered(_large_star(edges)))), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    roots = edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
