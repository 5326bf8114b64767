"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest node it knows; edges may come out repeated."""
    sym = _both_ways(edges)
    least = sym.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = sym.join(least, "a").filter(F.col("b") > F.col("a"))
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    # The edge to the smallest neighbour itself is the one that ties the node.
    tied = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
    return down.join(least, "a").select(tied.alias("a"), F.col("m").alias("b")).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node that has none itself; edges go down, each once."""
    ends = edges.select("a", F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("b", F.lit(0), F.lit(1)))
    each = ends.groupBy("a").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return each.filter((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """(a, b) for every node of the edges (a, b) but the smallest of each component, which is b.

    The two operations alternate until only stars are left, a number of rounds
    that grows with the logarithm of the nodes. Each round is written and the
    one before it removed; only a test reaches the driver.
    """
    now = edges.filter(F.col("a") != F.col("b")).select("a", "b")
    while True:
        before, now = now, materialize(_small_star(_large_star(now)), "stars")
        discard(before)
        if _only_stars(now):
            return now


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is
    its smallest node."""
    now = stars(edges)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
