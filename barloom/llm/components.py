"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import drop_stored, stored


def _large_star(links: DataFrame, spent: list[DataFrame]) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that adaptive execution can split the join at a node with many links
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    spent.append(least)
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, spent: list[DataFrame]) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the smallest of them."""
    least = stored(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    spent.append(least)
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component) for every node with a link: the smallest node reachable. Links are
    pairs of integers in any direction; loops and repeats do no harm. The number of rounds grows with the logarithm of
    the longest chain; each round is written to the shared folder."""
    pairs = links.select(F.col(first).alias("x"), F.col(second).alias("y")).where("x <> y")
    edges = stored(
        pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links"
    )
    while True:
        spent = [edges]
        starred = stored(_large_star(edges, spent), "links")
        spent.append(starred)
        following = stored(_small_star(starred, spent), "links")
        # done when every node has one link, to a node that has none to smaller ones
        linked = following.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        roots = following.select("b").distinct()
        open_nodes = linked.where("n > 1").select("a").unionByName(linked.join(roots, F.col("a") == F.col("b")).select("a"))
        finished = open_nodes.isEmpty()
        drop_stored(*spent)
        edges = following
        if finished:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
