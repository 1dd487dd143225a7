"""Connected components of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link; the root is the smallest node it reaches.

    Alternating stars need a number of rounds that grows with the logarithm of the links.
    Minima are pre-aggregated and joined back, so a node with very many links is never
    gathered in one task (adaptive execution splits its side of the join). Each round is a
    table in the shared folder; the driver compares two numbers per round. Links with a
    null end and links of a node to itself are ignored; repeated links count once.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges = materialize(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        edges = materialize(edges, "large-star")
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = (edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        edges = materialize(edges, "small-star")
        after = _shape(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
