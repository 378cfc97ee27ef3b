"""Numeric helpers. Ratios are double arithmetic on exact sums, so results do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: str | Column, denominator: str | Column, scale: float = 1.0) -> Column:
    """numerator / denominator * scale as double; NULL where the denominator is zero or NULL."""
    bottom = F.nullif(_col(denominator).cast("double"), F.lit(0.0))
    return _col(numerator).cast("double") / bottom * F.lit(float(scale))


def mean(value: str | Column) -> Column:
    """Average over non-null values from one exact sum, as double."""
    c = _col(value)
    return F.sum(c).cast("double") / F.nullif(F.count(c).cast("double"), F.lit(0.0))


def share(condition: Column, scale: float = 100.0) -> Column:
    """Percentage of rows where ``condition`` is true, over rows where it is not NULL."""
    return (
        F.count_if(condition).cast("double")
        / F.nullif(F.count(condition).cast("double"), F.lit(0.0))
        * F.lit(float(scale))
    )


def ladder(value: str | Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper bound that ``value`` lies strictly below."""
    c = _col(value)
    out = None
    for bound, label in steps:
        out = F.when(c < bound, label) if out is None else out.when(c < bound, label)
    return out.otherwise(otherwise)
