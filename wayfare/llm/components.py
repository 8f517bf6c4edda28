"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, joined_apart


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its smallest one. Neighbours meet their
    smallest one by a shuffle of both, so that a node with very many links can be split."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v") if large else edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = joined_apart(both, least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether edges (a, b), distinct and with a > b, link each node to the smallest of its
    component: none has two links up, or one up and one down."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("down"))
    return nodes.filter("ups > 1 or (ups = 1 and down = 0)").count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (a, b): the smallest node it can reach.
    Alternates between large and small stars until every node is linked to that one, each
    round written to the shared folder. Links of a node with itself or null are left out."""
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    edges = cut(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct())
    while not _settled(edges):
        edges = cut(_star(_star(edges, True), False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
