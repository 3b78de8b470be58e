"""Connected components of a table of links, by alternating star contraction.

Each round hangs every node on the least node it knows; the work is groupings and
joins on nodes, each round is written to the shared folder, and only a count
comes back to the driver. The number of rounds grows with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the least of them; edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (its least node) for every node of ``links`` (a, b: any ordered type)."""
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    while True:
        moved = stored(_small_star(_large_star(edges)), "stars")
        # A star forest has no node that is both a centre and a leaf, and every leaf has one centre.
        joined = moved.select(F.col("b").alias("node")).unionAll(moved.select(F.col("a").alias("node")).distinct())
        settled = joined.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        edges = moved
        if settled:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
