"""Connected components by large-star and small-star steps, in a number of rounds that grows with the logarithm of a path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrysql.operators.skew import look_up
from quarrysql.session import written


def _star(neighbours: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest of u and all its neighbours. Hubs of any size stay spread."""
    least = neighbours.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("_v"))
    found = look_up(neighbours, written(least, "star-least"), ["u"], "n")
    return found.select("u", "v", F.least("u", "_v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of them all. Each pair is seen from both ends."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return _star(edges.select(F.inline(ends))).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star-down")
    pairs = F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))
    return _star(down).select(F.inline(pairs)).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs) that is not its own root; the root is the smallest node.

    Only a count and a checksum of the pairs reach the driver. Each step is written to the shared folder.
    """
    current, before = written(edges.select("a", "b").where("a <> b").distinct(), "star"), None
    while True:
        sums = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(sums)
        current = written(_small_star(_large_star(current)), "star")
