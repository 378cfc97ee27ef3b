"""Usage, cost and run metrics over event tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.numbers import mean, ratio, share
from granary.functions.text import same_text

# Prices per 1,000 tokens, service levels and bands.
PRICES = {
    "gpt-4": ("0.03", "0.06"),
    "gpt-4-turbo": ("0.01", "0.03"),
    "gpt-3.5-turbo": ("0.0005", "0.0015"),
    "mock": ("0", "0"),
}
LATENCY_LIMIT_MS = 1500
SUCCESS_FLOOR_PCT = 95
FRESH_HOURS = 2
HISTOGRAM_BINS = 20
RUN_SLA_MINUTES = 30


# -- model calls -----------------------------------------------------------------------------


def price_table(spark: SparkSession) -> DataFrame:
    rows = [(m, i, o) for m, (i, o) in PRICES.items()]
    text = spark.createDataFrame(rows, "model string, input_price string, output_price string")
    return text.select(
        "model",
        F.col("input_price").cast("decimal(6,4)").alias("input_price"),
        F.col("output_price").cast("decimal(6,4)").alias("output_price"),
    )


def call_cost(calls: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Add ``cost_usd``, exact in decimals; an unknown model costs nothing."""
    # the fixed table has four rows; a caller's is joined as its size allows
    prices = F.broadcast(price_table(calls.sparkSession)) if prices is None else prices
    joined = calls.join(prices, "model", "left")  # one row per model
    zero = F.lit(0).cast("decimal(6,4)")
    per_thousand = F.col("input_tokens").cast("decimal(12,0)") * F.coalesce("input_price", zero) + F.col(
        "output_tokens"
    ).cast("decimal(12,0)") * F.coalesce("output_price", zero)
    cost = per_thousand.cast("decimal(16,4)") * F.lit("0.001").cast("decimal(3,3)")
    return joined.withColumn("cost_usd", cost.cast("decimal(20,7)")).drop("input_price", "output_price")


def last_days(df: DataFrame, as_of: str, days: int, column: str = "timestamp") -> DataFrame:
    """Rows of the ``days`` up to ``as_of``, both ends included."""
    end = datetime.fromisoformat(as_of)
    start = end - timedelta(days=days)
    return between(df, str(start), str(end), column)


def between(df: DataFrame, start: str, end: str, column: str = "timestamp") -> DataFrame:
    def at(text: str) -> Column:
        return F.lit(text).cast(dict(df.dtypes)[column])

    return df.filter(F.col(column).between(at(start), at(end)))


def of_role(df: DataFrame, role: str) -> DataFrame:
    return df.filter(F.col("role") == role)


def call_summary(calls: DataFrame, days: int) -> DataFrame:
    """One row of totals and rates; a fixed row of zeros when there are no calls."""
    n = F.count(F.lit(1))
    out = calls.agg(
        n.alias("total_calls"),
        F.coalesce(F.sum("total_tokens"), F.lit(0).cast("long")).alias("total_tokens"),
        F.coalesce(F.sum("cost_usd").cast("double"), F.lit(0.0)).alias("total_cost_usd"),
        F.coalesce(mean("latency_ms"), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(share(F.col("success")), F.lit(0.0)).alias("success_rate"),
        mean("confidence_score").alias("avg_confidence"),
        share(F.col("human_approved")).alias("human_approval_rate"),
    )
    return out.withColumn("period_days", F.when(F.col("total_calls") > 0, F.lit(days)).otherwise(0))


def _usage() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("calls"),
        F.sum("total_tokens").alias("tokens"),
        F.sum("cost_usd").cast("double").alias("cost_usd"),
        mean("latency_ms").alias("avg_latency_ms"),
    ]


def by_role(calls: DataFrame) -> DataFrame:
    return calls.groupBy("role").agg(*_usage(), mean("confidence_score").alias("avg_confidence"))


def daily_trend(calls: DataFrame) -> DataFrame:
    return calls.groupBy(F.to_date("timestamp").alias("day")).agg(*_usage()).orderBy("day")


def cost_by(calls: DataFrame, *dimensions: str) -> DataFrame:
    return calls.groupBy(*dimensions).agg(F.sum("cost_usd").cast("double").alias("cost_usd"))


def cumulative_cost(calls: DataFrame) -> DataFrame:
    """Daily and running cost. The window runs over one row per day."""
    daily = calls.groupBy(F.to_date("timestamp").alias("day")).agg(F.sum("cost_usd").alias("cost"))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("cumulative_cost", F.sum("cost").over(w))


def latency_by_hour(calls: DataFrame) -> DataFrame:
    out = calls.groupBy(F.hour("timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("calls"), mean("latency_ms").alias("avg_latency_ms")
    )
    return out.withColumn("breach", F.col("avg_latency_ms") > LATENCY_LIMIT_MS)


def confidence_histogram(calls: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts per role and equal-width bin over [0, 1]; the last bin includes 1."""
    position = F.floor(F.col("confidence_score") * bins).cast("int")
    number = F.least(position, F.lit(bins - 1))
    kept = calls.filter(F.col("confidence_score").isNotNull())
    return kept.groupBy("role", number.alias("bin")).agg(F.count(F.lit(1)).alias("calls"))


def confidence_range(calls: DataFrame) -> DataFrame:
    return calls.groupBy("role").agg(
        mean("confidence_score").alias("avg_confidence"),
        F.min("confidence_score").alias("min_confidence"),
        F.max("confidence_score").alias("max_confidence"),
    )


def rag_usage(calls: DataFrame) -> DataFrame:
    used = F.col("rag_chunks_used") > 0
    out = calls.agg(
        mean("rag_chunks_used").alias("avg_chunks"),
        share(used).alias("pct_with_chunks"),
        mean(F.when(used, F.col("confidence_score"))).alias("confidence_with"),
        mean(F.when(F.col("rag_chunks_used") == 0, F.col("confidence_score"))).alias("confidence_without"),
    )
    gain = ratio(F.col("confidence_with") - F.col("confidence_without"), "confidence_without", 100)
    return out.withColumn("improvement_pct", F.coalesce(gain, F.lit(0.0)))


def approval_by_role(calls: DataFrame) -> DataFrame:
    """Approved, decided and rate per role; the row with role NULL is the total."""
    decided = calls.filter(F.col("human_approved").isNotNull())
    return decided.rollup("role").agg(
        F.count_if(F.col("human_approved")).alias("approved"),
        F.count(F.lit(1)).alias("decided"),
        share(F.col("human_approved")).alias("approval_rate"),
    )


def calls_today(calls: DataFrame, as_of: str, days: int) -> DataFrame:
    since = F.lit(str(datetime.fromisoformat(as_of) - timedelta(days=1))).cast("timestamp")
    out = calls.agg(
        F.count_if(F.col("timestamp").cast("timestamp") >= since).alias("calls_today"),
        F.count(F.lit(1)).alias("calls"),
        ratio(F.sum("total_tokens"), F.count(F.lit(1))).alias("tokens_per_call"),
        F.sum("cost_usd").cast("double").alias("cost_usd"),
    )
    return out.withColumn("cost_per_day", F.col("cost_usd") / F.lit(float(days)))


def flag_thresholds(summary: DataFrame) -> DataFrame:
    """Labels for latency and success rate of rows with these columns."""
    return summary.withColumns(
        {
            "latency_label": F.when(F.col("avg_latency_ms") < LATENCY_LIMIT_MS, "GOOD").otherwise("SLOW"),
            "success_label": F.when(F.col("success_rate") > SUCCESS_FLOOR_PCT, "HEALTHY").otherwise("REVIEW"),
        }
    )


# -- pipeline runs ---------------------------------------------------------------------------


def filter_runs(runs: DataFrame, status: str | None = None, name: str | None = None) -> DataFrame:
    out = runs
    if status is not None:
        out = out.filter(F.col("status") == status)
    if name is not None:
        out = out.filter(same_text("run_name", name))
    return out


def run_status(state: str | Column, errors: str | Column, minutes: str | Column, sla: float = RUN_SLA_MINUTES) -> Column:
    def c(v):
        return F.col(v) if isinstance(v, str) else v

    return (
        F.when(c(state) == "Failed", "ERROR")
        .when((c(state) == "Warning") | (c(errors) > 0) | (c(minutes) > sla), "WARNING")
        .otherwise("HEALTHY")
    )


def run_stats(runs: DataFrame, as_of: str, hours: int = 24, sla: float = RUN_SLA_MINUTES) -> DataFrame:
    """Per pipeline over the last hours: runs, success rate, average minutes, records, SLA breaches."""
    end = datetime.fromisoformat(as_of)
    recent = between(runs, str(end - timedelta(hours=hours)), str(end), "start")
    return recent.groupBy("run_name").agg(
        F.count(F.lit(1)).alias("runs"),
        share(F.col("status") == "Success").alias("success_rate"),
        mean("duration_min").alias("avg_minutes"),
        F.sum("records").alias("records"),
        F.count_if(F.col("duration_min") > sla).alias("sla_breaches"),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """Last run per pipeline, as an aggregation: no pipeline's history is gathered in one task."""
    body = F.struct("start", "run_id", "status", "errors", "duration_min", "records")
    picked = runs.groupBy("run_name").agg(F.max(body).alias("_r")).select("run_name", "_r.*")
    return picked.withColumn("health", run_status("status", "errors", "duration_min"))


def recent_runs(runs: DataFrame, name: str, limit: int = 10) -> DataFrame:
    """Last runs of one pipeline, newest first."""
    return filter_runs(runs, name=name).orderBy(F.desc("start"), F.desc("run_id")).limit(limit)


def run_audit(runs: DataFrame, source: str = "start") -> DataFrame:
    """Audit rows: who ran when, for how long and with what error."""
    ended = F.timestamp_micros(
        F.unix_micros(F.col(source).cast("timestamp")) + (F.col("duration_min") * 60_000_000).cast("long")
    )
    return runs.select(
        F.substring(F.md5(F.col("run_id").cast("string")), 1, 8).alias("correlation_id"),
        "run_name",
        F.col(source).cast("timestamp").alias("started_at"),
        ended.alias("ended_at"),
        (F.col("duration_min") * 60).alias("duration_seconds"),
        F.when(F.col("status") == "Failed", F.concat(F.lit("run "), "run_id", F.lit(" failed"))).alias("error_message"),
        F.when(F.col("status") == "Failed", "failed").otherwise("completed").alias("outcome"),
    )


# -- alerts and platform totals --------------------------------------------------------------


def build_alerts(
    drift: DataFrame | None = None,
    runs: DataFrame | None = None,
    rules: DataFrame | None = None,
    fresh: DataFrame | None = None,
    sla: float = RUN_SLA_MINUTES,
) -> DataFrame:
    """Alert rows from drift assessments, slow runs, failed rules and stale tables."""

    def alert(df: DataFrame, severity: Column, title: str, subject: str, text: Column, action: str) -> DataFrame:
        return df.select(
            severity.alias("severity"),
            F.lit(title).alias("title"),
            F.col(subject).alias("subject"),
            text.alias("description"),
            F.lit(action).alias("recommended_action"),
        )

    parts = []
    if drift is not None:
        changed = drift.filter("change_count > 0")
        text = F.format_string("%d schema changes in %s", "change_count", "table_name")
        severity = F.col("severity")
        parts.append(alert(changed, severity, "Schema Drift Detected", "table_name", text, "Update data contract"))
    if runs is not None:
        slow = runs.filter(F.col("duration_min") > sla)
        worst = slow.groupBy("run_name").agg(F.count(F.lit(1)).alias("n"), F.max("duration_min").alias("worst"))
        text = F.format_string("%d runs of %s above %s min", F.col("n"), F.col("run_name"), F.lit(f"{sla:g}"))
        parts.append(alert(worst, F.lit("INFO"), "Slow Run", "run_name", text, "Review query performance"))
    if rules is not None:
        broken = rules.filter("status <> 'PASS'")
        severity = F.when(F.col("status") == "FAIL", "CRITICAL").otherwise("WARNING")
        subject = broken.withColumn("subject", F.concat("table_name", F.lit("."), "rule"))
        text = F.format_string("%d rows break %s", "violations", "rule")
        parts.append(alert(subject, severity, "Quality Rule Failed", "subject", text, "Inspect quarantined rows"))
    if fresh is not None:
        stale = fresh.filter("status <> 'PASS'")
        severity = F.when(F.col("status") == "ERROR", "ERROR").otherwise("WARNING")
        text = F.concat(F.col("table_name"), F.lit(" is stale"))
        parts.append(alert(stale, severity, "Stale Table", "table_name", text, "Check the ingestion run"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("severity") == "ERROR").alias("error_count"),
        F.count_if(F.col("severity") == "WARNING").alias("warning_count"),
        F.count_if(F.col("severity") == "INFO").alias("info_count"),
    )


def platform_kpis(
    fact: DataFrame, tables: DataFrame, latest: DataFrame, freshness: DataFrame, alerts: DataFrame
) -> DataFrame:
    """One row of platform totals; every input is reduced to a scalar."""
    runs = latest.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("health") == "HEALTHY").alias("ok"))
    ).scalar()
    weighted = F.sum(F.round("quality_score", 6).cast("decimal(12,6)") * F.col("row_count"))
    quality = tables.agg(
        F.struct(F.count(F.lit(1)).alias("n"), ratio(weighted, F.sum("row_count")).alias("score"))
    ).scalar()
    out = fact.agg(F.count(F.lit(1)).alias("total_records")).withColumns(
        {
            "_q": quality,
            "_r": runs,
            "freshness_hours": freshness.agg(F.min("age_hours")).scalar(),
            "open_alerts": alerts.agg(F.count(F.lit(1))).scalar(),
        }
    )
    return out.select(
        "total_records",
        F.col("_q.n").alias("tables_monitored"),
        F.col("_r.ok").alias("healthy_runs"),
        F.col("_r.n").alias("total_runs"),
        ratio("_r.ok", "_r.n", 100).alias("health_pct"),
        F.col("_q.score").alias("quality_score"),
        "freshness_hours",
        (F.col("freshness_hours") < FRESH_HOURS).alias("is_fresh"),
        "open_alerts",
    )
