"""Connected components of links, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtloom.session import forget, settle


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one at most, and what it leads to has none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    seen = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where("out > 1 or (out = 1 and into = 1)").limit(1).count() == 0


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` of every node in a link; the component's name is its smallest node.

    Stars are drawn to ever smaller centres: each node sends its larger neighbours to its smallest one, then its smaller ones,
    until there are only stars. Each round is two aggregations and joins over links; no neighbourhood is collected. Links with a
    null end are left out. The rounds grow as the logarithm of the longest path.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges = settle(edges, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        before, edges = edges, settle(large.join(small, "u").select(F.col("v").alias("x"), "m").where("x != m").select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        forget(before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
