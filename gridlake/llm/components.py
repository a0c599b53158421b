"""Connected components of links, as large-star and small-star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.sources.tables import settled


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node that links (`u`, `v`, any order, repeats allowed) lead to.

    Nodes without a link to another node are absent. Each step is a grouped minimum, combined before the shuffle and
    written, and a join that Spark can split as its sides are stored, so one node may have any number of links.
    Nothing is collected.
    """
    larger = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = settled(links.filter("u <> v").select(*larger).distinct(), "links")  # u > v
    before, now = None, _state(edges)
    while before != now:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = settled(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "least")
        # Large star: neighbours above a node are tied to its least neighbour (or itself).
        large = settled(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # Small star: a node's neighbours below it, and itself, are tied to the least of them.
        least = settled(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        below = large.join(least, "u")
        small = below.select(F.col("u"), F.col("m").alias("v")).union(below.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = settled(small.distinct(), "links")
        before, now = now, _state(edges)
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
