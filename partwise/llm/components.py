"""Connected components of a distributed edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import stored


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (hi > lo); root is the smallest node reachable.

    Each round hangs larger neighbours, then smaller ones, on the smallest
    neighbour; it ends when a round changes nothing. Minima are partial
    aggregates, and the joins that hand them back are split by adaptive
    execution where a root holds many nodes. Every round is written and reread.
    """
    edges, before = edges.select("hi", "lo").distinct(), None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v0")).select("u", F.least("u", "v0").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hung = large.join(lowest, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stored(hung.unionByName(lowest.select("hi", F.col("m").alias("lo"))).distinct(), "star")
        now = _state(edges)
        if now == before:
            roots = edges.select(F.col("lo").alias("node")).distinct().withColumn("root", F.col("node"))
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
        before = now
