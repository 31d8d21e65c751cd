"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.tables import stored


def _smallest_neighbour(links: DataFrame) -> DataFrame:
    """(u, v) rows with the smallest of u and its neighbours. Joined, not windowed, so that a hub can be split."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return links.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges(u, v)``; a component is named by its smallest node.

    Large-star and small-star steps alternate until nothing changes: each relinks the neighbours of a node to its
    smallest neighbour, so every component turns into a star around its smallest node in a number of rounds that
    grows with the logarithm of its size. Each round is written to the shared folder.
    """
    edges = stored(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    rows, mark = edges.count(), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = _smallest_neighbour(large).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u != v").distinct(), "edges", 2 * rows)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        rows, mark = now[0], now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
