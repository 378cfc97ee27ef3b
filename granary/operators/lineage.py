"""Lineage: reachable tables with their distance, upstream or downstream, and impact of a failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from granary.operators.skew import join_unique
from granary.session import discard, materialize

# The flow of the retail platform.
PLATFORM_EDGES = [
    ("oracle", "bronze.customers"),
    ("oracle", "bronze.products"),
    ("oracle", "bronze.stores"),
    ("sqlserver", "bronze.orders"),
    ("sqlserver", "bronze.order_items"),
    ("bronze.customers", "silver.stg_customers"),
    ("bronze.products", "silver.stg_products"),
    ("bronze.orders", "silver.stg_orders"),
    ("silver.stg_customers", "gold.dim_customer"),
    ("silver.stg_products", "gold.dim_product"),
    ("gold.dim_customer", "gold.fact_sales"),
    ("gold.dim_product", "gold.fact_sales"),
    ("gold.dim_date", "gold.fact_sales"),
    ("silver.stg_orders", "gold.fact_sales"),
    ("bronze.order_items", "gold.fact_sales"),
    ("gold.fact_sales", "bi"),
    ("gold.dim_customer", "bi"),
    ("gold.dim_product", "bi"),
    ("gold.fact_sales", "dashboards"),
]


def platform_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLATFORM_EDGES, "src string, dst string")


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``(root, node, depth)``: every node reachable from a root with its shortest distance.

    Path doubling: after ``t`` rounds all nodes less than ``2**t`` steps away are known, and ``steps`` holds the pairs that a
    walk of ``2**t`` steps joins; one join takes what is known that much further, another doubles the walks. So the rounds grow with
    the logarithm of the depth, and a chain has as many walks of a length as nodes. Every round is written to the shared
    folder and replaces the one before. Cycles end, as a node keeps its least distance.
    """
    steps, hop = materialize(edges.select("src", "dst").distinct(), "lineage-steps"), 1
    reached = materialize(roots.select(F.col("root"), F.col("root").alias("node"), F.lit(0).alias("depth")).distinct(), "lineage")
    known = reached.count()
    while True:
        ahead = reached.join(steps, F.col("node") == F.col("src")).select("root", F.col("dst").alias("node"), (F.col("depth") + hop).alias("depth"))
        further, seen = reached.unionByName(ahead).groupBy("root", "node").agg(F.min("depth").alias("depth")), Observation()
        now = materialize(further.observe(seen, F.count(F.lit(1)).alias("rows")), "lineage")
        discard(reached)
        if seen.get["rows"] == known:
            discard(steps)
            return now.filter("depth > 0")
        reached, known = now, seen.get["rows"]
        twice = steps.alias("a").join(steps.alias("b"), F.col("a.dst") == F.col("b.src")).select("a.src", "b.dst").distinct()
        longer = materialize(twice, "lineage-steps")
        discard(steps)
        steps, hop = longer, 2 * hop


def downstream(edges: DataFrame, roots: DataFrame) -> DataFrame:
    return closure(edges, roots)


def upstream(edges: DataFrame, roots: DataFrame) -> DataFrame:
    return closure(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), roots)


def impact(reached: DataFrame, roots: DataFrame) -> DataFrame:
    """Direct and indirect dependents per root as counts, and a severity.

    CRITICAL = feeds more than ten dependents or none (an end product people read), HIGH otherwise.
    """
    counts = reached.groupBy("root").agg(
        F.count_if(F.col("depth") == 1).alias("direct"),
        F.count_if(F.col("depth") > 1).alias("indirect"),
        F.max("depth").alias("max_depth"),
    )
    out = roots.select("root").distinct().join(counts, "root", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("direct", "indirect", "max_depth")})
    total = F.col("direct") + F.col("indirect")
    return out.withColumn("severity", F.when((total == 0) | (total > 10), "CRITICAL").otherwise("HIGH"))


def dependents(reached: DataFrame, edges: DataFrame) -> DataFrame:
    """The names behind ``impact``: a row per root and dependent, direct or indirect, and whether it is an end product,
    a node that feeds nothing further."""
    feeding = edges.select(F.col("src").alias("node")).distinct().withColumn("_feeds", F.lit(True))
    joined = join_unique(reached, feeding, ["node"], "left")
    relation = F.when(F.col("depth") == 1, "direct").otherwise("indirect")
    return joined.select("root", "node", relation.alias("relation"), F.col("_feeds").isNull().alias("end_product"))
