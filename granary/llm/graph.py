"""Connected components by alternating stars: every node is pulled towards the least node it can see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), the component being its least node.

    Each round is two aggregations with map-side combine and two joins on plain keys; nothing is gathered per node, so a
    node with many links is no hot group. The edges are written after each round, which keeps plans short and lets a
    lost executor cost one round at most. Null ends and loops are ignored; an empty table gives no rows.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        # large star: neighbours above a node move to the least node around it
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its neighbours below move to the least of them
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u <> v")
        now = materialize(small.distinct(), "links")
        told = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if told == seen:
            break
        seen = told
    top = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(top)
