"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """Link neighbours of a node to the least of them: the larger ones, or the smaller ones."""
    sides = edges.select("u", "v")
    if both:
        sides = sides.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    least = least.select("w", F.least("w", "m").alias("m"))
    joined = sides.join(least, sides["u"] == least["w"])
    if both:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return moved.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its least node) for every node of ``edges`` (``u``, ``v``, no nulls).

    Alternating stars: every round links neighbours to the least node known, until each
    component is one star. The number of rounds grows with the logarithm of the nodes;
    the edges never become more, and are cut loose of their past after each round. Only a
    count and a checksum of the edges reach the driver.
    """
    edges = cut(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        # The sum is over small hashes, so that it cannot overflow.
        check = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND((1 << 30) - 1))).first()
        if not check[0] or check == before:
            break
        before = check
        edges = cut(_stars(_stars(edges, both=True), both=False))
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
