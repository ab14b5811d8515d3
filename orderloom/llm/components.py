"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import join_per_key

from .common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it instead."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    return join_per_key(both, least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them instead."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_per_key(links, least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it reaches, for every node that has a link.

    ``links`` has longs ``a`` and ``b``; order, repeats and loops don't matter, no node may be null.
    Each round shrinks paths to stars; rows never exceed twice the links, and a node with very many
    links is reduced to its least neighbour before it is shuffled.
    """
    current = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        current = staged(_small_star(_large_star(current).distinct()).distinct(), "links")
