"""Row-level ingestion steps: stamping, schema enforcement, contract casts, watermarks."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sources.contracts import Contract

# Lineage columns of every raw table.
METADATA_COLUMNS = ("_ingestion_timestamp", "_source_system", "_batch_id", "_file_path")
PARTITION_COLUMN = "_ingestion_date"


class SchemaMismatch(ValueError):
    """A required column is missing or cannot take its declared type."""


def stamp_metadata(
    df: DataFrame,
    source_system: str,
    batch_id: str,
    ingested_at: datetime | Column,
    file_path: str | None = None,
) -> DataFrame:
    """Add the lineage columns and the partition date."""
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at).cast("timestamp")
    stamped = df.withColumns(
        {
            "_ingestion_timestamp": at,
            "_source_system": F.lit(source_system),
            "_batch_id": F.lit(batch_id),
            "_file_path": F.lit(file_path).cast("string"),
        }
    )
    return stamped.withColumn(PARTITION_COLUMN, F.to_date("_ingestion_timestamp"))


def extra_columns(df: DataFrame, expected: T.StructType) -> list[str]:
    known = set(expected.fieldNames()) | set(METADATA_COLUMNS) | {PARTITION_COLUMN}
    return sorted(set(df.columns) - known)


def enforce_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail on missing columns, cast the expected ones, keep extra columns at the end."""
    missing = sorted(set(expected.fieldNames()) - set(df.columns))
    if missing:
        raise SchemaMismatch(f"missing required columns: {missing}")
    rest = [c for c in df.columns if c not in set(expected.fieldNames())]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in expected], *rest)


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast to contract types, fill defaults, and list the columns whose value could not be cast."""
    columns, failures = [], []
    for f in contract.fields:
        raw = F.col(f.name)
        cast = raw.try_cast(f.spark_type())
        failures.append(F.when(raw.isNotNull() & cast.isNull(), F.lit(f.name)))
        if f.default is not None:
            # the default stands for a missing value only; an uncastable value stays NULL and is reported
            cast = F.when(raw.isNull(), F.lit(f.default).cast(f.spark_type())).otherwise(cast)
        columns.append(cast.alias(f.name))
    names = {f.name for f in contract.fields}
    rest = [c for c in df.columns if c not in names]
    return df.select(*columns, *rest, F.array_compact(F.array(*failures)).alias("_cast_failures"))


def after_watermark(df: DataFrame, column: str, watermark: datetime | None) -> DataFrame:
    """Rows past the high-water mark; the literal comparison reaches the scan."""
    return df if watermark is None else df.filter(F.col(column) > F.lit(watermark))


def high_water_mark(df: DataFrame, column: str = "_ingestion_timestamp") -> DataFrame:
    """One row with the largest processed source time, 1900-01-01 for an empty target."""
    return df.agg(F.coalesce(F.max(column), F.lit("1900-01-01").cast("timestamp")).alias("watermark"))


def incremental(df: DataFrame, target: DataFrame, column: str = "_ingestion_timestamp") -> DataFrame:
    """Rows of ``df`` newer than everything already in ``target`` (scalar subquery, no join)."""
    return df.filter(F.col(column) > high_water_mark(target, column).scalar())


def incremental_orders(
    orders: DataFrame, items: DataFrame, order_mark: datetime | None, item_mark: datetime | None
) -> DataFrame:
    """Order ids touched by new orders or by late items of old orders."""
    new_orders = after_watermark(orders, "_ingestion_timestamp", order_mark).select("order_id")
    new_items = after_watermark(items, "_ingestion_timestamp", item_mark).select("order_id")
    return new_orders.unionByName(new_items).distinct()


def with_audit(df: DataFrame, run_id: str, model: str, loaded_at: datetime | Column) -> DataFrame:
    at = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at).cast("timestamp")
    return df.withColumns({"_loaded_at": at, "_run_id": F.lit(run_id), "_model": F.lit(model)})


class Run(NamedTuple):
    """The run that builds a model; both are arguments, so a repeated run gives the same rows."""

    run_id: str
    loaded_at: datetime | Column


def audited(df: DataFrame, model: str, run: Run | None) -> DataFrame:
    """``df`` with the audit columns of ``run``, unchanged without one."""
    return df if run is None else with_audit(df, run.run_id, model, run.loaded_at)
