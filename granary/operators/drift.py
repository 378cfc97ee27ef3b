"""Schema drift: compare snapshot rows of many tables at once, rate the changes, report per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.session import materialize

# Change kinds.
ADDED, REMOVED = "COLUMN_ADDED", "COLUMN_REMOVED"
TYPE_CHANGED, NULLABLE_CHANGED = "TYPE_CHANGED", "NULLABLE_CHANGED"
RENAMED = "RENAMED"
#: Least hashes kept of a column's values, and the share of common values from which two columns are one.
SKETCH, SAME = 1024, 0.8
BREAKING_ACTIONS = [
    "Hold loads that read the table until its readers fit again",
    "Change the contract and every model that names the column",
    "Load the days since the change a second time",
]
ADDITIVE_ACTIONS = ["Decide whether the contract takes the new column"]
NO_ACTIONS = ["Nothing to do"]
CONFIDENCE = {"breaking": 0.85, "additive": 0.80, "none": 1.0}


def join_snapshots(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Both snapshots side by side; inputs have table_name, column_name, data_type, nullable."""

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            "table_name",
            "column_name",
            F.col("data_type").alias(f"{prefix}_type"),
            F.col("nullable").alias(f"{prefix}_nullable"),
        )

    return side(expected, "old").join(side(actual, "new"), ["table_name", "column_name"], "full_outer")


def columns_by_presence(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every column labelled added, removed or common."""
    label = (
        F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").otherwise("common")
    )
    joined = join_snapshots(expected, actual)
    return joined.select("table_name", "column_name", label.alias("presence"))


def _truth(c: str) -> Column:
    return F.when(F.col(c), "True").otherwise("False")


def compare(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per change."""
    joined = join_snapshots(expected, actual)
    gone, new = F.col("new_type").isNull(), F.col("old_type").isNull()
    both = ~gone & ~new

    def change(when: Column, kind: str, old: Column, now: Column) -> Column:
        body = F.struct(F.lit(kind).alias("change_type"), old.alias("old_value"), now.alias("new_value"))
        return F.when(when, body)

    nothing = F.lit(None).cast("string")
    changes = F.array_compact(
        F.array(
            change(new, ADDED, nothing, F.col("new_type")),
            change(gone, REMOVED, F.col("old_type"), nothing),
            change(both & (F.col("old_type") != F.col("new_type")), TYPE_CHANGED, F.col("old_type"), F.col("new_type")),
            change(
                both & (F.col("old_nullable") != F.col("new_nullable")),
                NULLABLE_CHANGED,
                _truth("old_nullable"),
                _truth("new_nullable"),
            ),
        )
    )
    return joined.select("table_name", "column_name", F.inline(changes))


def value_sketches(df: DataFrame, size: int = SKETCH) -> DataFrame:
    """``(column_name, h)``: the ``size`` least hashes of each column's different values (nulls left out).

    Two columns with at most ``size`` different values are compared exactly. Ranks are cut within each task before the
    shuffle, so the shuffle does not grow with the values' number.
    """
    cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.when(F.col(f"`{f.name}`").isNotNull(), F.xxhash64(F.col(f"`{f.name}`").cast("string"))).alias("h")) for f in df.schema])
    rows = df.select(F.inline(cells)).filter(F.col("h").isNotNull())
    place = F.dense_rank().over(Window.partitionBy("column_name").orderBy("h"))
    return rows.withColumn("_place", place).filter(F.col("_place") <= size).select("column_name", "h").distinct()


def renamed(changes: DataFrame, old_values: DataFrame, new_values: DataFrame, size: int = SKETCH, same: float = SAME) -> DataFrame:
    """``(table_name, old_name, new_name, similarity)``: removed columns that came back under another name.

    ``changes`` as ``compare`` gives them; ``old_values`` and ``new_values`` are ``value_sketches`` with a ``table_name``. The
    similarity of a removed and an added column of one type is the share of common hashes among the ``size`` least of both.
    Pairs of ``same`` or more are matched one to one: a pair holds if neither column has a better partner (higher
    similarity, then name) that is not itself better served elsewhere; few rows per table, settled round by round.
    """
    gone = changes.filter(F.col("change_type") == REMOVED).select("table_name", F.col("column_name").alias("old_name"), F.col("old_value").alias("kind"))
    new = changes.filter(F.col("change_type") == ADDED).select("table_name", F.col("column_name").alias("new_name"), F.col("new_value").alias("kind"))
    pairs = gone.join(new, ["table_name", "kind"]).select("table_name", "old_name", "new_name")
    left = pairs.join(old_values.withColumnRenamed("column_name", "old_name"), ["table_name", "old_name"]).withColumn("_old", F.lit(1))
    right = pairs.join(new_values.withColumnRenamed("column_name", "new_name"), ["table_name", "new_name"]).withColumn("_new", F.lit(1))
    key = ["table_name", "old_name", "new_name"]
    both = left.unionByName(right, allowMissingColumns=True).groupBy(*key, "h").agg(F.count("_old").alias("_old"), F.count("_new").alias("_new"))
    least = both.withColumn("_place", F.row_number().over(Window.partitionBy(*key).orderBy("h"))).filter(F.col("_place") <= size)
    scored = least.groupBy(*key).agg((F.count_if((F.col("_old") > 0) & (F.col("_new") > 0)) / F.count(F.lit(1))).alias("similarity"))
    open_ = materialize(scored.filter(F.col("similarity") >= same), "renames")
    found = None
    while True:
        by = lambda c, other: Window.partitionBy("table_name", c).orderBy(F.desc("similarity"), other)
        first = (F.row_number().over(by("old_name", "new_name")) == 1) & (F.row_number().over(by("new_name", "old_name")) == 1)
        settled = materialize(open_.withColumn("_first", first).filter("_first").drop("_first"), "renames")
        found = settled if found is None else found.unionByName(settled)
        rest = open_.join(settled.select("table_name", "old_name"), ["table_name", "old_name"], "left_anti").join(settled.select("table_name", "new_name"), ["table_name", "new_name"], "left_anti")
        open_ = materialize(rest, "renames")
        if open_.isEmpty():
            return found


def with_renames(changes: DataFrame, renames: DataFrame) -> DataFrame:
    """``changes`` with one ``RENAMED`` row in the place of the removal and the addition of each renamed column."""
    old, new = renames.select("table_name", F.col("old_name").alias("column_name")), renames.select("table_name", F.col("new_name").alias("column_name"))
    rest = changes.join(old.unionByName(new), ["table_name", "column_name"], "left_anti")
    rows = renames.select("table_name", F.col("new_name").alias("column_name"), F.lit(RENAMED).alias("change_type"), F.col("old_name").alias("old_value"), F.col("new_name").alias("new_value"))
    return rest.unionByName(rows)


def is_breaking() -> Column:
    tightened = (
        (F.col("change_type") == NULLABLE_CHANGED) & (F.col("old_value") == "True") & (F.col("new_value") == "False")
    )
    return F.col("change_type").isin(REMOVED, TYPE_CHANGED, RENAMED) | tightened


def assess(changes: DataFrame, tables: DataFrame) -> DataFrame:
    """Severity per table of ``tables(table_name)``; a table without changes is INFO."""
    per_table = changes.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("change_count"), F.max(is_breaking()).alias("breaking_change")
    )
    out = tables.select("table_name").distinct().join(per_table, "table_name", "left")
    out = out.withColumns(
        {
            "change_count": F.coalesce("change_count", F.lit(0).cast("long")),
            "breaking_change": F.coalesce("breaking_change", F.lit(False)),
        }
    )
    none = F.col("change_count") == 0
    severity = F.when(none, "INFO").when(F.col("breaking_change"), "ERROR").otherwise("WARNING")
    confidence = (
        F.when(none, CONFIDENCE["none"])
        .when(F.col("breaking_change"), CONFIDENCE["breaking"])
        .otherwise(CONFIDENCE["additive"])
    )
    return out.withColumns({"severity": severity, "confidence_score": confidence})


def report(changes: DataFrame, tables: DataFrame, downstream: DataFrame | None = None) -> DataFrame:
    """One row per table with its change list, severity, downstream tables and actions.

    The lists have at most two entries per column of a table, and one per dependent table, in order of name;
    ``downstream_count`` counts those. ``downstream`` has ``(table_name, dependent)`` rows, such as a lineage closure.
    """
    listed = changes.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("column_name", "change_type", "old_value", "new_value"))).alias("changes")
    )
    out = assess(changes, tables).join(listed, "table_name", "left")
    if downstream is not None:
        each = downstream.select("table_name", "dependent").distinct()
        dependents = each.groupBy("table_name").agg(
            F.count(F.lit(1)).alias("downstream_count"), F.sort_array(F.collect_list("dependent")).alias("affected_downstream")
        )
        out = out.join(dependents, "table_name", "left")
    else:
        out = out.withColumns({"affected_downstream": F.array().cast("array<string>"), "downstream_count": F.lit(0).cast("long")})

    def words(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    none = F.col("change_count") == 0
    impact = (
        F.when(none, F.lit("The columns are those of the contract"))
        .when(
            F.col("breaking_change"),
            F.format_string("%s lost or changed columns that its readers rely on", F.col("table_name")),
        )
        .otherwise(F.format_string("%s gained columns; its readers are not affected", F.col("table_name")))
    )
    actions = (
        F.when(none, words(NO_ACTIONS))
        .when(F.col("breaking_change"), words(BREAKING_ACTIONS))
        .otherwise(words(ADDITIVE_ACTIONS))
    )
    empty = F.array().cast("array<string>")
    return out.withColumns(
        {
            "downstream_count": F.when(none, F.lit(0).cast("long")).otherwise(F.coalesce("downstream_count", F.lit(0).cast("long"))),
            "affected_downstream": F.when(none, empty).otherwise(F.coalesce("affected_downstream", empty)),
            "business_impact": impact,
            "recommended_actions": actions,
            "requires_human_approval": F.lit(True),
        }
    )
