"""Connected components of a links table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.sources.storage import stored


def _least(links: DataFrame) -> DataFrame:
    """Each node of (u, v) with the least of its neighbours and itself."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is its least node.

    `links` may repeat, point either way and hold loops or nulls (ignored). Every round is written to the
    shared work folder, so lineage stays short and lost executors cost one round at most. A node
    with very many links meets its neighbours in joins that Spark may split, never in one group.
    """
    edges = links.filter(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        # Large star: larger neighbours of u are linked to the least node around u.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "large-star")
        # Small star: u and its smaller neighbours are linked to the least of them.
        small = large.join(_least(large), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(_least(large).select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stored(small, "small-star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
