"""Query registry: a Spark builder per name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as double, dates and times as text, so engines compare alike."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    def add(build: Builder) -> Builder:
        QUERIES[name] = lambda spark, folder: portable(build(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add
