"""Surrogate keys and row hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the widely used surrogate-key macro so that keys match across engines.
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text form of the columns; NULL has its own marker."""
    if all(isinstance(c, str) for c in columns):
        names = ", ".join(f"coalesce(cast(`{c}` as string), '{NULL_SENTINEL}')" for c in columns)
        return F.expr(f"md5(concat_ws('{SEPARATOR}', {names}))")
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_SENTINEL)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def date_key(column: str | Column) -> Column:
    """Integer yyyyMMdd key of a date or timestamp."""
    c = _col(column)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
