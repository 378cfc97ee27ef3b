"""Type-2 history: change detection, version building and point-in-time lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.keys import surrogate_key
from granary.operators.dedup import dedup_latest
from granary.operators.skew import SLICE, SPLIT_ROWS, carry_forward, join_unique, neighbours, per_part
from granary.session import discard, stage

# End of validity of an open version, and the columns whose change opens a new version.
OPEN_END = "9999-12-31 23:59:59"
CUSTOMER_TRACKED = [
    "first_name", "last_name", "email", "phone", "address_line1",
    "city", "state", "postal_code", "customer_segment", "is_active",
]
PRODUCT_TRACKED = ["product_name", "category_id", "brand", "unit_price", "unit_cost", "is_active"]

HISTORY_COLUMNS = ["surrogate_key", "valid_from", "valid_to", "is_current", "_row_hash"]


def change_hash(tracked: list[str]) -> Column:
    return surrogate_key(*tracked)


def detect_changes(incoming: DataFrame, current: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Label incoming rows INSERT, UPDATE or NO_CHANGE against the current versions."""
    now = current.select(key, change_hash(tracked).alias("current_hash"))
    out = join_unique(incoming.withColumn("row_hash", change_hash(tracked)), now, [key], "left")
    label = (
        F.when(F.col("current_hash").isNull(), "INSERT")
        .when(F.col("row_hash") != F.col("current_hash"), "UPDATE")
        .otherwise("NO_CHANGE")
    )
    return out.withColumn("change_type", label).select(*incoming.columns, "row_hash", "change_type")


def _close(df: DataFrame, key: str) -> DataFrame:
    out = neighbours(df, [key], ["valid_from"], following={"_next": "valid_from"})
    closed = out.withColumns(
        {
            "valid_to": F.coalesce("_next", F.lit(OPEN_END).cast("timestamp")),
            "is_current": ~F.col("_has_following"),
        }
    )
    return closed.drop("_next", "_has_following")


def close_versions(df: DataFrame, key: str, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Recompute ``valid_to`` and ``is_current`` from the next version of the same key."""
    base = df.drop("valid_to", "is_current")
    return per_part(base, [key], ["valid_from"], lambda part: _close(part, key), split_rows)


def build_history(
    df: DataFrame, key: str, tracked: list[str], updated_at: str, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Versions of every key from a feed of dated rows.

    Rows with equal key and time are reduced to the last ingested one, neighbours with equal tracked
    values are merged into the earlier one, and each version ends where the next begins.
    """
    arrival = [c for c in ("_ingestion_timestamp",) if c in df.columns]

    def build(part: DataFrame) -> DataFrame:
        # ordinary keys: one shuffle by key serves the aggregation and both windows;
        # hot keys: copies are reduced on the map side before their rows move, and each shuffle's rows are written,
        # without the hashes, which no compression makes smaller
        sliced = SLICE in part.columns
        if sliced:
            single = stage(dedup_latest(part, [key, updated_at], arrival), "hot-single")
            discard(part)
            hashed = single.withColumn("_row_hash", F.unhex(change_hash(tracked)))
        else:
            hashed = dedup_latest(part.repartition(F.col(key)).withColumn("_row_hash", change_hash(tracked)), [key, updated_at], arrival)
        seen = neighbours(hashed, [key], [updated_at], previous={"_prev_hash": "_row_hash"})
        changed = seen.filter(~F.col("_has_previous") | (F.col("_row_hash") != F.col("_prev_hash")))
        versions = changed.drop("_prev_hash", "_has_previous").withColumn("valid_from", F.col(updated_at))
        if sliced:
            versions = stage(versions.drop("_row_hash"), "hot-versions")
            discard(single)
        closed = _close(versions, key).withColumn("surrogate_key", surrogate_key(key, updated_at))
        if sliced:
            closed = closed.withColumn("_row_hash", change_hash(tracked))
        return closed.select(*part.columns, "_row_hash", "surrogate_key", "valid_from", "valid_to", "is_current")

    return per_part(df, [key], [updated_at, *arrival], build, split_rows)


def scd2_apply(
    history: DataFrame | None,
    incoming: DataFrame,
    key: str,
    tracked: list[str],
    updated_at: str = "source_updated_at",
    split_rows: int | None = SPLIT_ROWS,
    staged: bool = False,
) -> DataFrame:
    """New versions of the keys in ``incoming`` plus the untouched rest of ``history``.

    Repeated and multiple changes per batch give the same result as one rebuild from all rows. A late row is placed
    between the versions that ``history`` has; a row that once repeated the version before it is not among them, so feeds
    with late rows are better rebuilt per touched key from the raw rows (``rebuild_touched``). ``staged`` writes the touched
    keys, both parts of ``history`` and the rows to rebuild from, so that each step is a small plan and frees its shuffles;
    ``history`` is not read after the call.
    """
    if history is None:
        return build_history(incoming, key, tracked, updated_at, split_rows)
    write = stage if staged else lambda df, name: df
    touched_keys = write(incoming.select(key).distinct(), "touched-keys")
    untouched = write(join_unique(history, touched_keys, [key], "left_anti").select(*history.columns), "untouched")
    old = join_unique(history, touched_keys, [key], "left_semi").select(*history.columns)
    feed = write(old.drop(*HISTORY_COLUMNS).unionByName(incoming, allowMissingColumns=True), "touched")
    if staged:
        discard(touched_keys)
    rebuilt = build_history(feed, key, tracked, updated_at, split_rows)
    return untouched.unionByName(rebuilt, allowMissingColumns=True)


def rebuild_touched(
    feed: DataFrame, batch: DataFrame, key: str, tracked: list[str], updated_at: str = "source_updated_at", split_rows: int | None = SPLIT_ROWS, staged: bool = False
) -> DataFrame:
    """All versions of the keys in ``batch``, from every row that ``feed`` (which holds the batch too) has of them.

    ``LakeTable.replace`` puts them in the place of the old versions in one write: exact for late, repeated and
    corrected rows. ``staged`` writes the touched keys and their rows first, listed in the result's ``staged`` for a caller
    who has written the versions.
    """
    write = stage if staged else lambda df, name: df
    keys = write(batch.select(key).distinct(), "touched-keys")
    touched = write(join_unique(feed, keys, [key], "left_semi").select(*feed.columns), "touched")
    out = build_history(touched, key, tracked, updated_at, split_rows)
    out.staged = [keys, touched] if staged else []
    return out


def current_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_current"))


def versions_at(df: DataFrame, instant: str | Column) -> DataFrame:
    """Versions valid at one instant. The start counts, the end does not."""
    at = F.lit(instant).cast("timestamp") if isinstance(instant, str) else instant
    return df.filter((F.col("valid_from") <= at) & (at < F.col("valid_to")))


def join_as_of(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    columns: list[str],
    prefix: str = "asof_",
    split_rows: int | None = SPLIT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Left join of every fact to the version valid at its time.

    Facts and version starts are merged into one ordered sequence per key and the last version is
    carried forward, so a key with many facts and many versions costs their sum, not their product.
    ``sizes`` is a cheaper frame holding ``key`` with about as many rows per key, to find hot keys in.
    """
    version = F.struct(F.col("valid_to"), *[F.col(c) for c in columns])
    payload = F.struct(*[F.col(c) for c in facts.columns])
    starts = history.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_at"),
        F.lit(0).alias("_side"),
        version.alias("_version"),
    )
    events = facts.select(
        F.col(key).alias("_key"),
        F.col(at).cast("timestamp").alias("_at"),
        F.lit(1).alias("_side"),
        payload.alias("_fact"),
    )
    merged = starts.unionByName(events, allowMissingColumns=True)

    def fill(part: DataFrame) -> DataFrame:
        return carry_forward(part, ["_key"], ["_at", "_side"], "_version")

    slim = None if sizes is None else sizes.select(F.col(key).alias("_key"))
    filled = per_part(merged, ["_key"], ["_at", "_side"], fill, split_rows, slim)
    live = F.col("_at") < F.col("_version.valid_to")
    picked = [F.when(live, F.col(f"_version.{c}")).alias(f"{prefix}{c}") for c in columns]
    return filled.filter(F.col("_side") == 1).select("_fact.*", *picked)
