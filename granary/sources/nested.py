"""Nested JSON columns as VARIANT: their schema as snapshot rows for the drift check, and their fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sources.catalog import SNAPSHOT


def with_variant(df: DataFrame, column: str) -> DataFrame:
    """The JSON text of ``column`` parsed; text that is no JSON becomes null."""
    return df.withColumn(column, F.try_parse_json(F.col(column)))


def _fields(prefix: str, kind: T.DataType) -> list[tuple[str, str]]:
    if isinstance(kind, T.StructType):
        return [x for f in kind for x in _fields(f"{prefix}.{f.name}", f.dataType)]
    return [(prefix, kind.simpleString())]


def nested_snapshot(df: DataFrame, table: str, column: str) -> DataFrame:
    """``(table_name, column_name, data_type, nullable)`` for every field below a VARIANT ``column`` of all rows.

    The schemas of all values are merged in the aggregation; only the merged one comes to the driver.
    """
    found = df.agg(F.schema_of_variant_agg(F.col(column)).alias("s")).first()["s"]
    kind = T._parse_datatype_string((found or "VOID").replace("OBJECT<", "STRUCT<"))
    rows = [(table, name, text, True) for name, text in _fields(column, kind)]
    return df.sparkSession.createDataFrame(rows, SNAPSHOT)


def field_profile(df: DataFrame, column: str, fields: dict[str, str], by: list[str]) -> DataFrame:
    """Per group: rows, and for each field (JSON path to type) the rows that have it and its least and largest value."""
    parts = []
    for name, (path, kind) in {n: (f"$.{n}", k) for n, k in fields.items()}.items():
        value = F.try_variant_get(F.col(column), path, kind)
        parts += [F.count(value).alias(f"{name}_filled"), F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max")]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *parts)
