"""Connected components of a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.session import cut


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node below the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    # cut off, so that the join has plain exchanges on both sides and a hot node can be split
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours below the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node id of each component.

    ``nodes`` has a column node, ``edges`` has a and b. Rounds of large and
    small stars halve the depth of every tree, whatever the order of the ids,
    until nothing changes. Runs one job per round.
    """
    edges = cut(_directed(edges))
    seen = None
    while True:
        edges = cut(_small_star(_large_star(edges)))
        # a set of edges is known by the number and the sum of its hashes
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
