"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.session import checkpointed


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, of every linked node but the roots.

    ``links`` has columns ``a`` and ``b`` of an ordered type. Each round points nodes at the
    smallest neighbour of theirs or of a neighbour, so that long chains shrink by halves; a hub is
    only ever a key of partial aggregates and of joins that Spark can split.
    """
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = checkpointed(edges)
    seen = state(edges)
    while True:
        edges = checkpointed(small_star(large_star(edges)))
        now = state(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are linked to the smallest of them."""
    edges = edges.distinct()
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def state(edges: DataFrame) -> tuple:
    """Number and hash sum of the links: equal when a round changes nothing."""
    # a sum of 32-bit parts stays exact in decimals for any number of links
    part = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(part)).first())
