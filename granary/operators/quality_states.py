"""Quality over time from mergeable states: counts and extremes per layer and ingestion day, stored once.

A new day costs one pass over that day's rows; trends and totals are sums over states. A day that is delivered again
replaces its own state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.quality import quality_trend
from granary.sources.tables import LakeTable


def day_states(df: DataFrame, layer: str, time: str, ok: Column, columns: list[str]) -> DataFrame:
    """``(layer, day, checks, passed, <column>_filled, <column>_min, <column>_max...)``: one row per day."""
    parts = [f(c).alias(f"{c}_{name}") for c in columns for f, name in ((F.count, "filled"), (F.min, "min"), (F.max, "max"))]
    day = F.to_date(time).alias("day")
    passed = F.sum(F.coalesce(ok.cast("int"), F.lit(0))).alias("passed")
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("checks"), passed, *parts).withColumn("layer", F.lit(layer))


def save(table: LakeTable, states: DataFrame) -> None:
    table.replace(states, ["layer", "day"])


def trend(table: LakeTable, layers: list[str]) -> DataFrame:
    return quality_trend(table.read().select("layer", "day", "passed", "checks"), layers)


def totals(table: LakeTable, columns: list[str]) -> DataFrame:
    """Per layer: rows, rows that passed, and for each column its filled rows and extremes over all days."""
    parts = [f(f"{c}_{name}").alias(f"{c}_{name}") for c in columns for f, name in ((F.sum, "filled"), (F.min, "min"), (F.max, "max"))]
    return table.read().groupBy("layer").agg(F.sum("checks").alias("checks"), F.sum("passed").alias("passed"), *parts)
