"""Connected components of an edge table by alternating star contraction (Kiveris et al., 2014), without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm.common import discard, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orderable type -> (node, root): the smallest node that each node of an edge reaches.

    A large star links every larger neighbour of a node to the node's smallest neighbour, a small star does so for the
    smaller ones; alternating them ends, after a number of rounds in the square of the logarithm of the nodes, with each component a star
    around its minimum; rounds go on until one changes nothing. Each round is written to the shared
    folder, which cuts the lineage, and replaces the one before. Minima are pre-aggregated before their shuffle; the joins that hand them back to a
    hub's neighbours are plain equi-joins, which adaptive execution splits when a hub is hot.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # every node keeps one smaller neighbour at least, so from here on (a, b) has b < a
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        nxt = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select("a", F.col("low").alias("b"))).distinct()
        last, now = now, stage(nxt, "edges")
        discard(last)
        new = _mark(now)
        if new == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("s")).first()
    return (row.n, row.x, row.s)
