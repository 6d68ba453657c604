"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import checkpoint


def _star(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Nearest neighbour of each ``u`` of ``pairs (u, v)``, joined to the rows of ``links``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").withColumn("m", F.least("m", "u"))


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; the root is its component's smallest
    node.  Each round hangs larger neighbours, then smaller ones, on a node's least neighbour;
    minima combine before the shuffle and AQE splits a hub's rows in the join.  A round's result
    is checkpointed, which also ends lineage.  Nothing but two sums reaches the driver."""
    edges = checkpoint(links.where(F.col("a") != F.col("b"))
                       .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_star(both, both).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _star(down, down)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small.select("u", F.col("m").alias("v")))
                 .where(F.col("u") != F.col("v")).distinct())
        edges = checkpoint(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
