"""Latest row per key as an aggregation.

``max(struct(order..., rest...))`` keeps one candidate per key on the map side, so a key with a
third of all rows sends one row per task instead of filling one window group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _latest(keys: list[str], order: list[str], columns: list[str]) -> Column:
    rest = [c for c in columns if c not in keys and c not in order]
    return F.max(F.struct(*order, *rest))


def dedup_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by all other columns."""
    columns = df.columns
    picked = df.groupBy(*keys).agg(_latest(keys, order, columns).alias("_row"))
    return picked.select(*keys, "_row.*").select(*columns)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their row count."""
    present = None
    for k in keys:
        present = F.col(k).isNotNull() if present is None else present & F.col(k).isNotNull()
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
