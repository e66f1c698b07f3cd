"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame) -> DataFrame:
    """(id, component): for every id of the edges (u, v) the smallest id it reaches.

    Each round first links every larger neighbour of a node to the node's least neighbour, then every smaller one; both are a
    grouping with partial minima and a join with its result, so a node with very many neighbours is never gathered in one
    task. Rounds end when the edges are stars, after a number that grows with the logarithm of a component's size.
    """
    now = store(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.*")
        after = store(small.filter("u <> v").distinct())
        # stars: every node has one edge, and none of the centres has an edge to a smaller node
        open_nodes = after.groupBy("u").count().filter("count > 1").select("u")
        chained = after.select("v").join(after.select(F.col("u").alias("v")), "v", "left_semi")
        now = after
        if not open_nodes.take(1) and not chained.take(1):
            break
    centres = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)
