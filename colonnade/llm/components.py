"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step keeps components as they are and replaces edges by stars around smaller nodes; the number of rounds is logarithmic in the
longest chain. Edges stay a distributed table throughout. A node's neighbours are never gathered in one place: a step joins each edge
with its node's smallest neighbour, which is an aggregate, and a join that may be split where a node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import skew_join, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return skew_join(both.where("b > a"), least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them. Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = skew_join(edges, least, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    return moved.unionByName(least.select(F.col("m").alias("x"), F.col("b").alias("y"))).where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), where root is the smallest node of its component.

    Loops and repeated edges are of no consequence; edges with a null end are ignored; no edges give no rows.
    """
    now = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), clean=False)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = state(now)
    while seen[0]:
        after = stored(_small_star(_large_star(now)), clean=False)
        told = state(after)
        now = after
        if told == seen:
            break
        seen = told
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
