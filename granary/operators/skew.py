"""Joins and neighbour access within a key that stay parallel when one key holds a large share of all rows.

Joins to a side that holds each key once are planned so that Spark's own skew handling can split their hot keys while the
join runs; nothing is counted beforehand.

A plain ``lag``/``lead`` window puts a whole key into one task. One aggregation (a count per key, combined on the map
side) looks for keys above ``split_rows``; usually there are none and the plain window is used. The rows of hot keys are
sorted over all order columns and cut into slices of a quarter of that many rows, so neither a burst in time nor equal or
missing times put a key into one slice. Each slice is its own window group, and the one row at each edge is carried over.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.session import stage

SPLIT_ROWS = 2_000_000
SLICE = "_slice"
_SLICES_PER_QUOTA = 4
MANY_KEYS = 10_000


def _both(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def hot_keys(df: DataFrame, keys: list[str], split_rows: int = SPLIT_ROWS) -> DataFrame | None:
    """Keys with more than ``split_rows`` rows as ``_hot_<key>`` columns and ``_n``, None if there are none.

    The counts are taken once and written; only the small result is looked at again.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_hot_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(counts.filter(F.col("_n") > split_rows), "hot-keys")
    return None if hot.isEmpty() else hot


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join to a side that holds each key once: inner, left, left_semi or left_anti. NULL keys match nothing.

    The keys are compared as one struct. Where ``right`` is itself an aggregation or window by the same keys, the planner
    would reuse its partitioning, and adaptive execution splits skewed partitions only between two plain exchanges.
    """
    named = right.filter(_both([F.col(k).isNotNull() for k in keys]))
    rest = [c for c in right.columns if c not in keys]
    named = named.select(F.struct(*keys).alias("_right_key"), *rest)
    others = [c for c in left.columns if c not in keys]
    out = left.select(F.struct(*keys).alias("_left_key"), *others).join(named, F.col("_left_key") == F.col("_right_key"), how)
    mine = [*[F.col("_left_key")[k].alias(k) for k in keys], *others]  # the keys are shuffled once, in the struct
    return out.select(*mine, *([] if how in ("left_semi", "left_anti") else rest))


def split_hot(
    df: DataFrame, keys: list[str], order: list[str], split_rows: int = SPLIT_ROWS, sizes: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with the slice they lie in or None if there are no hot keys).

    Keys are counted in ``sizes`` if given: a cheaper frame with the same key columns and at least as many rows per key.
    The hot part is written to the shared folder once, as it is read several times.
    """
    hot = hot_keys(df if sizes is None else sizes, keys, split_rows)
    if hot is None:
        return df, None
    on = _both([F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    quota = max(1, split_rows // _SLICES_PER_QUOTA)
    n_rows, n_keys = hot.agg(F.sum("_n"), F.count(F.lit(1))).first()
    ranges = -(-n_rows // quota)
    tasks = min(ranges, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # rows of one key and one order value are told apart by their other columns, so a burst is many ranges, too
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    ranged = [*keys, *order, tie]
    rows = df.join(hot, on).select(*df.columns).repartitionByRange(tasks, *ranged).sortWithinPartitions(*ranged)
    # ids count the sorted rows of each range, so a slice is the next ``quota`` of them
    sliced = stage(rows.withColumn(SLICE, F.floor(F.monotonically_increasing_id() / quota)), "hot-rows")
    cold = df.join(hot, on, "left_anti")
    # beyond what is broadcast, telling the rows apart is a shuffle of all of them
    return stage(cold, "cold-rows") if n_keys > MANY_KEYS else cold, sliced


def _joined_to_edges(local: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    on = [local[SLICE] == edges["_edge_slice"]]
    on += [local[k].eqNullSafe(edges[f"_edge_{k}"]) for k in keys]
    return local.join(edges, _both(on), "left")


def _edge_keys(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"_edge_{k}") for k in keys] + [F.col(SLICE).alias("_edge_slice")]


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Add columns of the row before and after within each key; the maps are ``{new: existing}``.

    Also adds ``_has_previous`` / ``_has_following``, which tell a missing row from a NULL value.
    A frame with a slice column is handled slice by slice.
    """
    previous, following = previous or {}, following or {}
    before = F.struct(F.lit(True).alias("_is"), *dict.fromkeys(previous.values()))
    after = F.struct(F.lit(True).alias("_is"), *dict.fromkeys(following.values()))
    if SLICE not in df.columns:
        w = Window.partitionBy(*keys).orderBy(*order)
        out = df.withColumns({"_before": F.lag(before).over(w), "_after": F.lead(after).over(w)})
    else:
        rank = F.struct(*order)
        by_slice = Window.partitionBy(*keys).orderBy(SLICE)
        ends = [-1] * bool(previous) + [1] * bool(following)
        edges = (
            df.groupBy(*keys, SLICE)
            .agg(F.max_by(before, rank).alias("_last"), F.min_by(after, rank).alias("_first"))
            .select(
                *keys,
                SLICE,
                *[F.lag("_last").over(by_slice).alias("_edge_before")] * bool(previous),
                *[F.lead("_first").over(by_slice).alias("_edge_after")] * bool(following),
                F.explode(F.array(*map(F.lit, ends))).alias("_edge"),
            )
        )
        # the neighbours beyond a slice are rows at its ends, so one shuffle places the rows; what is
        # looked at is put together behind that shuffle, so no column is moved twice
        rows = df.withColumn("_edge", F.lit(0)).unionByName(edges, allowMissingColumns=True)
        w = Window.partitionBy(*keys, SLICE).orderBy("_edge", *order)
        inside = F.col("_edge") == 0
        seen = {}
        if previous:
            seen["_before"] = F.lag(F.when(inside, before).otherwise(F.col("_edge_before"))).over(w)
        if following:
            seen["_after"] = F.lead(F.when(inside, after).otherwise(F.col("_edge_after"))).over(w)
        out = rows.repartition(*keys, SLICE).withColumns(seen).filter(inside) if seen else df
    added = [F.col(f"_before.{old}").alias(new) for new, old in previous.items()]
    added += [F.col(f"_after.{old}").alias(new) for new, old in following.items()]
    if previous:
        added.append(F.col("_before").isNotNull().alias("_has_previous"))
    if following:
        added.append(F.col("_after").isNotNull().alias("_has_following"))
    return out.select(*df.columns, *added)


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Replace NULLs of ``value`` by the last non-null value at or before the row within its key."""
    sliced = SLICE in df.columns
    w = (
        Window.partitionBy(*keys, *([SLICE] if sliced else []))
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = df.withColumn("_carried", F.last(value, ignorenulls=True).over(w))
    if sliced:
        earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        # max_by skips rows whose ordering value is NULL, so only non-null values compete
        rank = F.when(F.col(value).isNotNull(), F.struct(*order))
        edges = (
            df.groupBy(*keys, SLICE)
            .agg(F.max_by(value, rank).alias("_last"))
            .select(*_edge_keys(keys), F.last("_last", ignorenulls=True).over(earlier).alias("_edge_value"))
        )
        out = _joined_to_edges(out, edges, keys).withColumn("_carried", F.coalesce("_carried", "_edge_value"))
    return out.select(*[F.col("_carried").alias(c) if c == value else F.col(c) for c in df.columns])


def per_part(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    build: Callable[[DataFrame], DataFrame],
    split_rows: int | None = SPLIT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Apply ``build`` to the ordinary and to the sliced hot rows and put both together.

    ``split_rows=None`` skips the count, for input whose rows per key are bounded by its grain, such
    as one row per key and month.
    """
    if split_rows is None:
        return build(df)
    cold, hot = split_hot(df, keys, order, split_rows, sizes)
    out = build(cold)
    return out if hot is None else out.unionByName(build(hot).drop(SLICE))


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    return per_part(df, keys, order, lambda part: neighbours(part, keys, order, previous, following), split_rows)
