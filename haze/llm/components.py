"""Connected components of a link table by alternating large and small stars.

Each round is two aggregations and joins; nothing is collected. A node with a
third of all links is an aggregation key (combined before the shuffle) and a
join key that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haze.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v): larger neighbours (or, small, the node
    and its smaller ones) move to the smallest of the neighbourhood."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        moved = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = (down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return moved.filter("u <> v") if large else moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns); the
    component is its smallest node. Nodes without links are not listed."""
    a, b = links.columns
    edges = written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "cc")
    seen = None
    while True:
        edges = written(_stars(_stars(edges, True), False), "cc")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", F.col("v").alias("component")).distinct())
