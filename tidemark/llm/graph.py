"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is its smallest node.

    Alternating large-star and small-star rounds: every node's neighbours are moved to
    the smallest one among them, the larger and the smaller ones by turns, until each
    component is a star.  Both steps are a minimum per node (summed before the shuffle)
    and a join back, so the neighbours of a hub are never gathered in one place.
    """
    edges = cut(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u != v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b"))
        small = moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct()
        edges = cut(small.select(F.col("a").alias("u"), F.col("b").alias("v")), "small-star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
