"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.llm.scratch import forget, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component``: the smallest node that can be reached. Nodes without links are absent.

    Each round hangs every neighbour of a node on the smallest one around it, first among the larger
    neighbours, then among the smaller; chains halve, so rounds grow with the logarithm of their
    length. Sums by node reduce before the shuffle, and rounds are cut by a written table.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    )
    before = None
    while True:
        old, edges = edges, written(_small_star(_large_star(edges)))
        forget(old)
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("v")
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.filter("v > u").join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u")
    moved = hung.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()
