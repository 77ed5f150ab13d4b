"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.sources import stage


def _all_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, and no ``v`` has an edge on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out")))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    return not nodes.agg(F.max((F.col("out") > 1) | (F.col("out") > F.col("least")))).first()[0]


def _centres(edges: DataFrame) -> DataFrame:
    """The least neighbour of every ``u`` (or ``u`` itself); combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("centre"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the least node reachable.

    Each round hangs all larger neighbours of a node on its least neighbour, then the smaller ones, until there are
    only stars; rounds grow with the logarithm of the longest chain, and stars take none. Every round is written
    to the shared scratch folder. Nulls and loops are ignored, repeated edges count once, no edges give no rows.
    Nodes may be of any type that has an order. A hub's edges are joined with one row per node, so the join can be split.
    """
    current = stage(
        edges.where((F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    while not _all_stars(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_centres(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("centre").alias("v"))
        )  # repeated edges do no harm, there are no more than before, and the round ends with distinct ones
        small = large.join(_centres(large), "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("centre").alias("v"))
        current = stage(small.where("u != v").distinct(), "edges")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select("root", "root").distinct().toDF("node", "root"))
