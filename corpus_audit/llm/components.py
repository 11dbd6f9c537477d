"""Connected components of a link table by alternating large-star and small-star steps, each a shuffle on one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_audit.llm.common import stash


def _settled(edges: DataFrame) -> bool:
    """Every node points at one node only, and none that is pointed at points on: the edges are stars around their smallest."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("held"))
    ends = ends.unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("held")))
    ends = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("held").alias("held"))
    return ends.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("held") > 0))).isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of a link the smallest node that links lead to.

    Every step points nodes at smaller neighbours until each node points at the root of its tree; the number of steps
    grows with the logarithm of the longest path.  The steps are written out, so lineage stays short.  Links of a node
    with itself, and nodes that have none, are not returned; no links give no rows.
    """
    a, b = F.col(a), F.col(b)
    edges = stash(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stash(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(roots).distinct()
