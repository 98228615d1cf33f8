"""Connected components by alternating large and small stars, written to the shared folder after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrysql.session import written


def _large(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Ties every smaller neighbour of a node, and the node, to the smallest of them; edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(others).distinct()


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    Null ends and loops are left out. The rounds end when no edge changes; their number grows with the
    logarithm of the graph's size. Only a count and a checksum of a round reach the driver.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    last = None
    while True:
        edges = written(_small(_large(edges)), label)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return written(stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), label)
