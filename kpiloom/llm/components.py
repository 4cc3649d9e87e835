"""Connected components of an edge table: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import saved


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.min(h), F.max(h)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    return (both.join(least, both["a"] == least["u"]).where("b > a")
                .select(F.col("b").alias("a"), F.least("m", "u").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them (edges run from larger to smaller)."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.join(least, edges["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge (a, b).

    A node with many edges meets only partial aggregates and joins whose skewed
    partitions can be split.  Only a count and checksums reach the driver.
    """
    now = saved(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _checksum(now)
    while before[0]:
        now = saved(_small_star(_large_star(now)))
        after = _checksum(now)
        if after == before:
            break
        before = after
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
               .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
