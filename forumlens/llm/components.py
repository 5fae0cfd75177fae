"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is one grouping and one join; a node with very many neighbours only meets them through
a minimum that is combined before the shuffle and a join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; the label is the smallest node of its component."""
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut(edges)
    seen = _digest(edges)
    while seen[0]:
        edges = cut(_small_star(cut(_large_star(edges))))
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
