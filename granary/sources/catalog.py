"""Schema snapshots: column rows of a table, as input of the drift check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "table_name string, column_name string, data_type string, nullable boolean"


def snapshot_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable) for name, df in tables.items() for f in df.schema]
    return spark.createDataFrame(rows, SNAPSHOT)


def snapshot_of_catalog(spark: SparkSession, table_names: list[str]) -> DataFrame:
    rows = [(t, c.name, c.dataType, c.nullable) for t in table_names for c in spark.catalog.listColumns(t)]
    return spark.createDataFrame(rows, SNAPSHOT)


def column_profile(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """A row per column of each table: place, type, rows and rows with a value, from one pass over each table."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"_c{j}") for j, f in enumerate(df.schema)])
        fields = [
            F.struct(F.lit(f.name).alias("column_name"), F.lit(j + 1).alias("position"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"_c{j}").alias("filled"))
            for j, f in enumerate(df.schema)
        ]
        parts.append(counts.select(F.lit(name).alias("table_name"), F.col("_rows").alias("rows"), F.inline(F.array(*fields))))
    return reduce(DataFrame.unionByName, parts)
