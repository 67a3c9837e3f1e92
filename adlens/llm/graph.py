"""Connected components of an edge table, as repeated joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, keep) -> DataFrame:
    """Hang the neighbours of each u on the least of them (and of u)."""
    pairs = saved(pairs, "pairs")
    least = saved(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    hung = keep(pairs.join(least, "u"))
    return hung.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the least node.

    Alternates the large-star and small-star steps until nothing changes; the
    edge table never grows, hubs are pre-aggregated and the joins are between
    written tables, so Spark can split a hub's rows. Rounds grow with the
    logarithm of the longest chain.
    """
    now = saved(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        large = _star(_both(now), lambda x: x.where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = saved(_star(down, lambda x: x.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            x.select("u", F.col("m").alias("v")))), "edges")
        found = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if found == mark:
            break
        mark = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
