"""Data-quality rules, gates, freshness and scorecards.

All row-level rules of a table are counted in one pass over it. Uniqueness and foreign keys need
their own shuffle and are added as further one-row results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.numbers import ratio
from granary.operators.dedup import duplicate_keys
from granary.operators.skew import join_unique
from granary.sources.contracts import Contract, Rule

RESULT_COLUMNS = ["table_name", "rule", "kind", "severity", "rows_checked", "violations", "status"]

# Score bands.
GREEN_FROM, YELLOW_FROM = 98, 95


def violation(rule: Rule) -> Column:
    """True where a row breaks the rule. NULL values break only ``not_null``."""
    if rule.kind == "not_null":
        return F.col(rule.columns[0]).isNull()
    if rule.kind == "accepted_values":
        return F.coalesce(~F.col(rule.columns[0]).isin(*rule.values), F.lit(False))
    if rule.kind == "regex":
        return F.coalesce(~F.col(rule.columns[0]).rlike(rule.pattern), F.lit(False))
    if rule.kind == "comparison":
        return F.coalesce(~F.expr(rule.expression), F.lit(False))
    raise ValueError(f"{rule.kind} is not a row-level rule")


def is_row_level(rule: Rule) -> bool:
    return rule.kind not in ("uniqueness", "referential_integrity")


def _with_status(df: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("violations") == 0, "PASS").when(F.col("severity") == "critical", "FAIL").otherwise("WARN")
    )
    return df.withColumn("status", status).select(*RESULT_COLUMNS)


def row_rules(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """One result row per rule from a single aggregation of the table."""
    counts = [F.count_if(violation(r)).alias(f"_r{i}") for i, r in enumerate(rules)]
    one = df.agg(F.count(F.lit(1)).alias("rows_checked"), *counts)
    results = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.kind).alias("kind"),
                F.lit(r.severity).alias("severity"),
                F.col(f"_r{i}").alias("violations"),
            )
            for i, r in enumerate(rules)
        ]
    )
    out = one.select(F.lit(table).alias("table_name"), "rows_checked", F.inline(results))
    return _with_status(out)


def uniqueness(df: DataFrame, table: str, rule: Rule) -> DataFrame:
    """Violations = keys that occur more than once."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
    per_key = df.filter(present).groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
    out = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_checked"),
        F.count_if(F.col("n") > 1).alias("violations"),
    )
    return _labelled(out, table, rule)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return join_unique(child.filter(F.col(child_key).isNotNull()), known, [child_key], "left_anti").select(*child.columns)


def relationship(child: DataFrame, parent: DataFrame, table: str, rule: Rule) -> DataFrame:
    """Foreign-key rule. Child keys are counted first, so the join sees each key once."""
    key = rule.columns[0]
    per_key = child.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_fk")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(rule.target_column).alias("_pk")).distinct()
    joined = per_key.join(known, F.col("_fk") == F.col("_pk"), "left")
    out = joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_checked"),
        F.coalesce(F.sum(F.when(F.col("_pk").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("violations"),
    )
    return _labelled(out, table, rule)


def _labelled(df: DataFrame, table: str, rule: Rule) -> DataFrame:
    out = df.select(
        F.lit(table).alias("table_name"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.severity).alias("severity"),
        "rows_checked",
        "violations",
    )
    return _with_status(out)


def run_rules(
    df: DataFrame, table: str, rules: tuple[Rule, ...] | list[Rule], parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Results of all rules of a table; foreign keys need their parent in ``parents``."""
    flat = [r for r in rules if is_row_level(r)]
    parts = [row_rules(df, table, flat)] if flat else []
    parts += [uniqueness(df, table, r) for r in rules if r.kind == "uniqueness"]
    for r in rules:
        if r.kind == "referential_integrity":
            if r.target_table not in (parents or {}):
                raise ValueError(f"rule {r.name} needs the table {r.target_table}")
            parts.append(relationship(df, parents[r.target_table], table, r))
    return reduce(DataFrame.unionByName, parts)


def run_summary(results: DataFrame) -> DataFrame:
    """Tests run, passed and failed per table."""
    out = results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("tests_run"),
        F.count_if(F.col("status") == "PASS").alias("tests_passed"),
        F.count_if(F.col("status") != "PASS").alias("tests_failed"),
        F.count_if(F.col("status") == "FAIL").alias("critical_failed"),
    )
    return out.withColumn("status", F.when(F.col("tests_failed") == 0, "PASSED").otherwise("FAILED"))


def nullability_and_type(raw: DataFrame, contract: Contract) -> DataFrame:
    """Per contract field: NULLs where none are allowed, and values that do not fit the type."""
    counts = []
    for f in contract.fields:
        value = F.col(f.name)
        counts.append(F.count_if(value.isNull() & F.lit(not f.nullable)).alias(f"_n_{f.name}"))
        counts.append(F.count_if(value.isNotNull() & value.try_cast(f.spark_type()).isNull()).alias(f"_t_{f.name}"))
    one = raw.agg(F.count(F.lit(1)).alias("rows_checked"), *counts)
    fields = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.spark_type().simpleString()).alias("data_type"),
                F.col(f"_n_{f.name}").alias("null_violations"),
                F.col(f"_t_{f.name}").alias("type_violations"),
            )
            for f in contract.fields
        ]
    )
    return one.select(F.lit(contract.table).alias("table_name"), "rows_checked", F.inline(fields))


def severity_gate(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split rows: (passing with their warnings, quarantined with their reasons)."""

    def names(severity: str) -> Column:
        hits = [F.when(violation(r), F.lit(r.name)) for r in rules if is_row_level(r) and r.severity == severity]
        return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")

    marked = df.withColumns({"_quarantine_reasons": names("critical"), "_warnings": names("warning")})
    bad = F.size("_quarantine_reasons") > 0
    return marked.filter(~bad).drop("_quarantine_reasons"), marked.filter(bad)


def split_orphans(
    items: DataFrame, orders: DataFrame, key: str = "order_id"
) -> tuple[DataFrame, DataFrame]:
    """(items with an order, items without one). A NULL key has no order; a part that is not read costs nothing."""
    known = orders.select(key).distinct()
    return join_unique(items, known, [key], "left_semi"), join_unique(items, known, [key], "left_anti")


def freshness(df: DataFrame, table: str, as_of: str, warn_hours: float, error_hours: float, column: str) -> DataFrame:
    """Age of the newest row against its limits; an empty table is an error."""
    newest = df.agg(F.max(F.col(column).cast("timestamp")).alias("newest"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("newest")).cast("double") / F.lit(3.6e9)
    status = (
        F.when(F.col("newest").isNull() | (F.col("age_hours") > error_hours), "ERROR")
        .when(F.col("age_hours") > warn_hours, "WARN")
        .otherwise("PASS")
    )
    aged = newest.select(F.lit(table).alias("table_name"), "newest", age.alias("age_hours"))
    return aged.withColumn("status", status)


def table_quality(
    df: DataFrame, table: str, required: list[str], key: list[str], typed: dict[str, str] | None = None
) -> DataFrame:
    """Row and column counts with NULL, uniqueness and type violations, and a score of clean cells."""
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in required])
    types = reduce(
        lambda a, b: a + b,
        [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()) for c, t in (typed or {}).items()],
        F.count_if(F.lit(False)),
    )
    flat = df.agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("null_violations"), types.alias("type_violations"))
    extra = duplicate_keys(df, key).agg(
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("long").alias("unique_violations")
    )
    joined = flat.withColumn("unique_violations", extra.scalar())
    cells = F.col("row_count") * F.lit(len(required) + len(typed or {}) + 1)
    bad = F.col("null_violations") + F.col("type_violations") + F.col("unique_violations")
    return joined.select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        "null_violations",
        "unique_violations",
        "type_violations",
        F.coalesce(ratio(cells - bad, cells, 100), F.lit(100.0)).alias("quality_score"),
    )


def overall_quality(tables: DataFrame) -> DataFrame:
    """Row-weighted average of the table scores."""
    weighted = F.sum(F.round("quality_score", 6).cast("decimal(12,6)") * F.col("row_count"))
    return tables.agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("row_count").alias("rows"),
        ratio(weighted, F.sum("row_count")).alias("overall_score"),
    )


def score_band(score: str | Column) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.when(c >= GREEN_FROM, "GREEN").when(c >= YELLOW_FROM, "YELLOW").otherwise("RED")


def scorecard(
    df: DataFrame,
    table: str,
    layer: str,
    required: list[str],
    key: list[str],
    rules: list[Rule],
    loaded_at: str,
    as_of: str,
    fresh_hours: float,
) -> DataFrame:
    """Completeness, uniqueness, validity and freshness in percent, their mean, and tests passed/failed.

    completeness = filled required cells, uniqueness = distinct keys per row, validity = rule checks
    passed, freshness = rows loaded within ``fresh_hours`` before ``as_of``.
    """
    flat = [r for r in rules if is_row_level(r)]
    filled = reduce(lambda a, b: a + b, [F.count(F.col(c)) for c in required])
    age = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col(loaded_at).cast("timestamp"))
    counts = [F.count_if(violation(r)).alias(f"_r{i}") for i, r in enumerate(flat)]
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        filled.alias("filled"),
        F.count_if(age <= int(fresh_hours * 3_600_000_000)).alias("fresh"),
        *counts,
    )
    keys = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).agg(F.count(F.lit(1)).alias("keys"))
    joined = one.withColumn("keys", keys.scalar())
    bad = reduce(lambda a, b: a + b, [F.col(f"_r{i}") for i in range(len(flat))], F.lit(0))
    passed = reduce(lambda a, b: a + b, [(F.col(f"_r{i}") == 0).cast("int") for i in range(len(flat))], F.lit(0))
    checks = F.col("n") * len(flat)
    out = joined.select(
        F.lit(table).alias("table_name"),
        F.lit(layer).alias("layer"),
        ratio("filled", F.col("n") * len(required), 100).alias("completeness"),
        ratio("keys", "n", 100).alias("uniqueness"),
        F.coalesce(ratio(checks - bad, checks, 100), F.lit(100.0)).alias("validity"),
        ratio("fresh", "n", 100).alias("freshness"),
        (passed + (F.col("keys") == F.col("n")).cast("int")).cast("long").alias("tests_passed"),
        (F.lit(len(flat)) - passed + (F.col("keys") != F.col("n")).cast("int")).cast("long").alias("tests_failed"),
    )
    total = F.col("completeness") + F.col("uniqueness") + F.col("validity") + F.col("freshness")
    out = out.withColumn("overall", total / 4)
    return out.withColumn("band", score_band("overall"))


def layer_quality(scores: DataFrame) -> DataFrame:
    """Mean overall score per layer, rounded to one digit, with test counts."""
    return scores.groupBy("layer").agg(
        F.round(F.avg(F.round("overall", 6).cast("decimal(12,6)")).cast("double"), 1).alias("overall"),
        F.sum("tests_passed").alias("tests_passed"),
        F.sum("tests_failed").alias("tests_failed"),
    )


def quality_trend(daily: DataFrame, layers: list[str]) -> DataFrame:
    """``(day, layer, checks, passed)`` rows as one row per day with one score column per layer."""
    grouped = daily.groupBy("day").pivot("layer", layers)
    sums = grouped.agg(F.sum("passed").alias("p"), F.sum("checks").alias("c"))
    return sums.select("day", *[ratio(f"{x}_p", f"{x}_c", 100).alias(x) for x in layers])
