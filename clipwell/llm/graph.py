"""Connected components of an edge table by star contraction, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwell.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of comparable values to (node, root): root is the smallest node that can be reached.

    Nodes without an edge to another node are absent; an empty table gives no
    rows. Each round hooks all neighbours of a node to the smallest one, larger
    neighbours first and then smaller ones, until nothing but stars is left.
    Minima are aggregated before the shuffle, so a hub is no hot key there.
    """
    pair = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    pair, state = durable(pair), None
    while True:
        both = pair.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            pair.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pair = durable(small.unionByName(low.withColumnRenamed("m", "lo")).distinct())
        # edges only move to smaller ends; equal count and sum of hashes mean that nothing moved
        now = tuple(pair.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())
        if now == state or not now[0]:
            return pair.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = now
