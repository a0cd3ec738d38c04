"""Connected components of a graph given by its links, without a hot node in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import cut, drop


#: Edges a task takes at least: a small graph's rounds are a few tasks and files.
ROWS_A_TASK = 100_000


def components(links: DataFrame) -> DataFrame:
    """node, component: each node of ``links`` (columns a, b) with the smallest node it is linked to, by whatever way.

    Alternates two steps that keep components: each node's larger neighbours are tied to
    its smallest neighbour, then its smaller ones are.  Both are a minimum by node and a
    join with it, so a node with many links is combined before the shuffle and its links
    are split by the join.  A component is done when it is a star about its smallest node;
    rounds grow with the logarithm of the longest chain, and end when one changes nothing.
    """
    spark = links.sparkSession
    digest = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = digest(edges)
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        before, edges = edges, cut(small.coalesce(max(1, -(-seen[0] // ROWS_A_TASK))))
        was, seen = seen, digest(edges)
        drop(spark, before)
        if was == seen:  # equal counts and equal sums of hashes
            break
    stars = edges.groupBy("u").agg(F.min("v").alias("component"))
    return stars.select(F.col("u").alias("node"), "component").unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
