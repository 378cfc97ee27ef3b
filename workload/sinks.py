"""Registered queries that write tables or run streams, then read the result back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from granary.operators import bronze, cleaning, quality, quality_states, sketches
from granary.operators.dedup import dedup_latest
from granary.operators.scd2 import current_only
from granary.plans import gold, silver
from granary.session import discard, fresh_path, stage
from granary.sources import calls as call_files
from granary.sources import nested
from granary.sources.contracts import ORDERS
from granary.sources.tables import LakeTable
from granary.sources.writer import BronzeWriter
from granary.streaming import audit, freshness
from granary.streaming import runs as streams
from workload import inputs as i
from workload.registry import register
from workload.retail import (
    CLEAN_CUSTOMER_COLUMNS,
    CUSTOMER_TIMES_SQL,
    DIM_CUSTOMER_SQL,
    HISTORY_SQL,
    ORDER_RAW_SQL,
    PRODUCT_SQL,
    QUALITY_TREND_SQL,
    STRAY_ITEMS,
    _dim_customer,
    _stray_items,
)
from workload.sql import mean, query, ts

CUT = "1999-01-01 00:00:00"


def _before(df, column="updated_at"):
    return df.filter(F.col(column) < F.lit(CUT).cast("timestamp"))


def _after(df, column="updated_at"):
    return df.filter(F.col(column) >= F.lit(CUT).cast("timestamp"))


def _first_orders(s, d):
    """Orders as first delivered: one row per order."""
    return i.orders(s, d).filter("created_at = updated_at")


def _returned(s, d):
    return i.orders(s, d).filter("created_at < updated_at")


@register(
    "sink_overwrite",
    query(f"select {ORDER_RAW_SQL} from raw_orders where created_at < updated_at", "raw_orders"),
)
def sink_overwrite(s, d):
    table = LakeTable(s, fresh_path(s, "overwrite"))
    table.overwrite(_first_orders(s, d))
    table.overwrite(_returned(s, d))
    return table.read().drop("_ingestion_timestamp")


@register(
    "sink_append",
    query(f"select {ORDER_RAW_SQL}, 'b' || case when created_at < updated_at then '2' else '1' end as _batch_id from raw_orders", "raw_orders"),
)
def sink_append(s, d):
    """Two batches; the second is delivered twice and counted once."""
    table = LakeTable(s, fresh_path(s, "append"))
    keys = ["order_id", "_batch_id"]
    table.append(_first_orders(s, d).withColumn("_batch_id", F.lit("b1")), keys)
    again = _returned(s, d).withColumn("_batch_id", F.lit("b2"))
    table.append(again, keys)
    table.append(again, keys)
    return table.read().drop("_ingestion_timestamp")


LATEST_RAW = "(select * from raw_orders qualify row_number() over (partition by order_id order by updated_at desc) = 1)"


@register("sink_merge", query(f"select {ORDER_RAW_SQL} from {LATEST_RAW}", "raw_orders"))
def sink_merge(s, d):
    """Returned orders replace their first delivery; the rerun changes nothing."""
    table = LakeTable(s, fresh_path(s, "merge"), ["order_month"])
    month = F.date_format("order_date", "yyyy-MM")
    table.merge(_first_orders(s, d).withColumn("order_month", month), ["order_id"])
    update = _returned(s, d).withColumn("order_month", month)
    table.merge(update, ["order_id"])
    table.merge(update, ["order_id"])
    return table.read().drop("_ingestion_timestamp", "order_month")


@register("set_merge_union", query(f"select order_id, order_status from {LATEST_RAW} order by all", "raw_orders"))
def set_merge_union(s, d):
    """The upsert as plain set operations: unmatched old rows plus all new rows."""
    new = _returned(s, d)
    kept = _first_orders(s, d).join(new.select("order_id"), "order_id", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True).select("order_id", "order_status")


@register(
    "sink_quarantine",
    query(
        f"""select order_item_id, order_id, 'no matching order' as _quarantine_reason, 'shop' as _source_system, 'b1' as _batch_id
        from {STRAY_ITEMS} where order_id not in (select order_id from raw_orders)""",
        "raw_items",
        "raw_orders",
    ),
)
def sink_quarantine(s, d):
    _, bad = quality.split_orphans(_stray_items(s, d), i.orders(s, d))
    writer = BronzeWriter(s, fresh_path(s, "quarantine"))
    bad = bad.drop("_ingestion_timestamp")
    writer.quarantine(bad, "order_items", "no matching order", "b1", source_system="shop", ingested_at=datetime(2024, 1, 1))
    rejected = writer.table("order_items_quarantine").read()
    return rejected.select("order_item_id", "order_id", "_quarantine_reason", "_source_system", "_batch_id")


@register(
    "sink_bronze_write",
    query(
        f"""select {ORDER_RAW_SQL}, case when created_at < updated_at then '2024-01-02 00:00:00' else '2024-01-01 00:00:00' end
            as _ingestion_timestamp, 'shop' as _source_system,
          case when created_at < updated_at then 'b2' else 'b1' end as _batch_id, cast(null as varchar) as _file_path,
          case when created_at < updated_at then '2024-01-02' else '2024-01-01' end as _ingestion_date from {LATEST_RAW}""",
        "raw_orders",
    ),
)
def sink_bronze_write(s, d):
    writer = BronzeWriter(s, fresh_path(s, "bronze"))
    for n, rows in enumerate((_first_orders(s, d), _returned(s, d)), start=1):
        writer.write(
            rows.drop("_ingestion_timestamp"),
            "orders",
            "shop",
            ["order_id"],
            batch_id=f"b{n}",
            expected_schema=ORDERS.schema(),
            ingested_at=datetime(2024, 1, n),
        )
    return writer.table("orders").read()


@register(
    "table_info",
    query(
        """select count(*) as row_count, 13 as column_count, 2 as latest_version, 'merge,overwrite' as operations,
          (select count(*) from raw_orders where created_at < updated_at) as last_batch_rows
        from (select distinct order_id from raw_orders)""",
        "raw_orders",
    ),
)
def table_info(s, d):
    table = LakeTable(s, fresh_path(s, "info"))
    table.merge(_first_orders(s, d), ["order_id"])
    last = table.merge(_returned(s, d), ["order_id"])
    info = table.info()
    operations = ",".join(o["operation"] for o in info["recent_operations"])
    row = (info["row_count"], info["column_count"], info["latest_version"], operations, last["rows"])
    return s.createDataFrame(
        [row], "row_count bigint, column_count int, latest_version int, operations string, last_batch_rows bigint"
    )


@register("sink_model_table", query(DIM_CUSTOMER_SQL, "dim_customer"))
def sink_model_table(s, d):
    table = LakeTable(s, fresh_path(s, "dim-customer"))
    table.overwrite(_dim_customer(s, d))
    return table.read()


@register("sink_model_incremental", query(f"select {PRODUCT_SQL}, {HISTORY_SQL} from stg_products", "stg_products"))
def sink_model_incremental(s, d):
    """History table in three runs: rows that arrive late, are delivered again or were wrong at first end as one rebuild."""
    table = LakeTable(s, fresh_path(s, "history"))
    return _history_in_runs(table, i.products(s, d), "product_id", silver.stg_products, silver.rebuilt_products)


@register("sink_customers_incremental", query(f"select {', '.join(CLEAN_CUSTOMER_COLUMNS)}, {CUSTOMER_TIMES_SQL}, {HISTORY_SQL} from stg_customers", "stg_customers"))
def sink_customers_incremental(s, d):
    table = LakeTable(s, fresh_path(s, "customers"))
    return _history_in_runs(table, i.customers(s, d), "customer_id", silver.stg_customers, silver.rebuilt_customers)


def _history_in_runs(table, raw, key, first_run, rebuilt):
    """Thirds of the rows by a hash, not by date, so that most keys get rows between those they have; the second run also
    delivers wrong rows, which the third corrects, and the third repeats the first run's rows."""
    raw = stage(raw, "feed")  # all runs read it
    third = F.pmod(F.xxhash64(key, "updated_at"), F.lit(3))
    first, second, last = (raw.filter(third == n) for n in range(3))
    wrong = last.withColumn("is_active", ~F.col("is_active")).withColumn("_ingestion_timestamp", F.lit("1990-01-01").cast("timestamp"))
    table.replace(first_run(first), [key])
    second = second.unionByName(wrong)
    versions = rebuilt(first.unionByName(second), second, staged=True)
    table.replace(versions, [key], sources=versions.staged)
    last = last.unionByName(first)
    versions = rebuilt(raw.unionByName(wrong).unionByName(first), last, staged=True)
    table.replace(versions, [key], sources=versions.staged)
    discard(raw)
    return table.read().drop("_ingestion_timestamp")


@register(
    "sink_fact_incremental",
    query(
        """select order_item_id, order_status, cast(net_revenue as double) as net_revenue,
          cast(gross_profit as double) as gross_profit from fact_sales""",
        "fact_sales",
    ),
)
def sink_fact_incremental(s, d):
    """Sales fact built in two runs; the second rebuilds orders that changed or got late items."""
    raw, items = i.orders(s, d), i.items(s, d)
    products = stage(current_only(silver.stg_products(i.products(s, d), split_rows=None)), "products")

    def fact(orders, lines):
        single = dedup_latest(lines, ["order_item_id"], ["_ingestion_timestamp"])
        return gold.fact_sales(single, silver.stg_orders(orders), products, sizes=lines, staged=True)

    table = LakeTable(s, fresh_path(s, "fact"))
    first = fact(_before(raw, "_ingestion_timestamp"), _before(items, "_ingestion_timestamp"))
    table.merge(first, ["fact_sales_key"], sources=first.staged)
    mark = datetime(1998, 12, 31, 23, 59, 59)
    changed = stage(bronze.incremental_orders(raw, items, mark, mark), "changed")
    again = fact(raw.join(changed, "order_id", "left_semi"), items.join(changed, "order_id", "left_semi"))
    table.merge(again, ["fact_sales_key"], sources=[*again.staged, changed, products])
    return table.read().select("order_item_id", "order_status", "net_revenue", "gross_profit")


CALLS_OUT = (
    f"call_id, {ts('timestamp')} as timestamp, role, model, total_tokens, cast(latency_ms as double) as latency_ms, success"
)


@register("sink_metrics_json", query(f"select {CALLS_OUT} from calls", "calls"))
def sink_metrics_json(s, d):
    """Written as JSON lines in two appends, read back line by line."""
    path = fresh_path(s, "calls-lines")
    calls = i.calls(s, d)
    call_files.write_calls(calls.filter("success"), path)
    call_files.write_calls(calls.filter("not coalesce(success, false)"), path)
    return call_files.from_json_rows(s.read.text(path).withColumnRenamed("value", "json")).select(
        "call_id", "timestamp", "role", "model", "total_tokens", "latency_ms", "success"
    )


@register("src_metrics_json", query(f"select {CALLS_OUT} from calls", "calls"))
def src_metrics_json(s, d):
    path = fresh_path(s, "calls-json")
    call_files.write_calls(i.calls(s, d), path)
    return call_files.read_calls(s, path).select(
        "call_id", "timestamp", "role", "model", "total_tokens", "latency_ms", "success"
    )


# -- streams -----------------------------------------------------------------------------------


def _stream(s, d, name):
    """A test table as a stream, whether it is one file or a folder of files; a stream takes a single file by a pattern only."""
    schema = i.table(s, d, name).schema
    return streams.file_stream(s, f"{d}/{{{name}}}.parquet", schema, "*")


@register(
    "stream_bronze_ingest",
    """select c.conv_id, c.turn, c.role, md5(c.text) as text_md5, 'chat' as _source_system, 'stream-0' as _batch_id from conversations c
    qualify row_number() over (partition by conv_id, turn order by role desc, text desc) = 1""",
)
def stream_bronze_ingest(s, d):
    table = LakeTable(s, fresh_path(s, "stream-bronze"))
    stream = _stream(s, d, "conversations").withColumn("_at", F.lit("2024-01-01").cast("timestamp"))
    streams.ingest_merge(
        stream, table, ["conv_id", "turn"], ["role", "text"], "chat", "_at", fresh_path(s, "checkpoint")
    ).awaitTermination()
    return table.read().select("conv_id", "turn", "role", F.md5("text").alias("text_md5"), "_source_system", "_batch_id")


@register(
    "stream_dedup_append",
    query(f"select order_item_id, quantity, cast(line_total as double) as line_total, {ts('created_at')} as created_at from items", "items"),
)
def stream_dedup_append(s, d):
    table = LakeTable(s, fresh_path(s, "stream-items"))
    stream = i.items_from(_stream(s, d, "lineitem"))
    streams.append_once(
        stream, table, ["order_item_id"], ["_ingestion_timestamp"], fresh_path(s, "checkpoint")
    ).awaitTermination()
    return table.read().select("order_item_id", "quantity", "line_total", "created_at")


@register(
    "stream_metrics_window",
    query(
        f"""select {ts("w")} as window_start, {ts("w + interval 1 hour")} as window_end, role, count(*) as calls,
          cast(sum(total_tokens) as bigint) as tokens, {mean("latency_ms")} as avg_latency_ms
        from (select *, date_trunc('hour', timestamp) as w from calls)
        where w + interval 1 hour <= (select max(date_trunc('millisecond', timestamp)) - interval 10 minutes from calls)
        group by w, role""",
        "calls",
    ),
)
def stream_metrics_window(s, d):
    """Hourly windows the watermark has closed; the newest one stays open."""
    path = fresh_path(s, "stream-windows")
    calls = i.calls_from(_stream(s, d, "events"))
    out = streams.windowed_calls(calls, "timestamp", "1 hour", "10 minutes")
    streams.to_parquet(out, path, fresh_path(s, "checkpoint")).awaitTermination()
    return s.read.schema(out.schema).parquet(path)


@register(
    "stream_metrics_sliding",
    query(
        f"""select {ts("w")} as window_start, {ts("w + interval 1 day")} as window_end, role, count(*) as calls,
          cast(sum(total_tokens) as bigint) as tokens, {mean("latency_ms")} as avg_latency_ms
        from (select *, unnest([date_trunc('day', timestamp) + to_hours(12 * (h - 2)) for h in [1, 2, 3]]) as w from calls)
        where w <= timestamp and timestamp < w + interval 1 day
          and w + interval 1 day <= (select max(date_trunc('millisecond', timestamp)) - interval 10 minutes from calls)
        group by w, role""",
        "calls",
    ),
)
def stream_metrics_sliding(s, d):
    path = fresh_path(s, "stream-sliding")
    calls = i.calls_from(_stream(s, d, "events"))
    out = streams.windowed_calls(calls, "timestamp", "1 day", "10 minutes", slide="12 hours")
    streams.to_parquet(out, path, fresh_path(s, "checkpoint")).awaitTermination()
    return s.read.schema(out.schema).parquet(path)


@register(
    "stream_freshness",
    f"""select event_type as table_name, {ts("max(ts)")} as newest, count(*) as rows,
      cast(epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(max(ts)) as double) / 3.6e9 as age_hours,
      case when cast(epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(max(ts)) as double) / 3.6e9 > 0.5 then 'STALE' else 'FRESH' end as status
    from events group by 1""",
)
def stream_freshness(s, d):
    table = LakeTable(s, fresh_path(s, "stream-fresh"))
    stream = _stream(s, d, "events").select(
        F.col("event_type").alias("table_name"), F.col("ts").cast("timestamp").alias("ts")
    )
    streams.newest_per_table(stream, "table_name", "ts", table, fresh_path(s, "checkpoint")).awaitTermination()
    return streams.freshness_of(table.read(), i.EVENTS_NOW, 0.5)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@register(
    "stream_freshness_changes",
    f"""with e as (select event_type, ts, lead(ts) over (partition by event_type order by ts) as nxt, max(ts) over () as newest from events)
    select event_type as table_name, 'STALE' as status, {ts("ts + interval 1 hour")} as at from e
      where nxt > ts + interval 1 hour or (nxt is null and ts + interval 1 hour <= date_trunc('millisecond', newest) - interval 10 minutes)
    union all select event_type, 'FRESH', {ts("nxt")} from e where nxt > ts + interval 1 hour""",
)
def stream_freshness_changes(s, d):
    """Every silence of more than an hour per event type, found by event-time timers."""
    path, before = fresh_path(s, "stream-gaps"), s.conf.get("spark.sql.streaming.stateStore.providerClass")
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        out = freshness.changes(_stream(s, d, "events"), "event_type", "ts", "1 hour", "10 minutes")
        streams.to_parquet(out, path, fresh_path(s, "checkpoint")).awaitTermination()
    finally:
        s.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return s.read.schema(out.schema).parquet(path)


@register("run_audit_stream", "select 'items' as query, 'SUCCESS' as status, count(*) as input_rows, cast(null as varchar) as error from lineitem")
def run_audit_stream(s, d):
    """Run rows that a listener takes from a stream over all order items; its batches sum to the input."""
    listener, path = audit.RunAudit(), fresh_path(s, "runs")
    s.streams.addListener(listener)
    try:
        writer = _stream(s, d, "lineitem").writeStream.format("parquet").queryName("items").option("path", fresh_path(s, "stream-copy"))
        query_ = writer.option("checkpointLocation", fresh_path(s, "checkpoint")).trigger(availableNow=True).start()
        query_.awaitTermination()
        listener.wait(query_)
    finally:
        s.streams.removeListener(listener)
    listener.flush(s, path)
    runs = s.read.schema(audit.RUNS).parquet(path)
    return runs.groupBy("query", "status", "error").agg(F.sum("input_rows").alias("input_rows"))


@register(
    "agg_distinct_sketches",
    """select event_type, count(*) as rows, count(distinct user_id) as users, count(distinct event_id) as events, true as users_close, true as events_close
    from events group by 1""",
)
def agg_distinct_sketches(s, d):
    """Distinct keys per event type from stored daily sketches alone, held against exact counts: within 3 %."""
    keys, table = ["user_id", "event_id"], LakeTable(s, fresh_path(s, "sketches"), ["day"])
    events = i.table(s, d, "events")
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for part in (events.filter(half), events.filter(~half)):  # two loads; the second leaves the first one's days alone
        table.replace(sketches.daily_sketches(part, F.to_date("ts"), ["event_type"], keys), ["day", "event_type"])
    found = sketches.distinct_counts(table.read(), ["event_type"], keys)
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_id").alias("events"))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.03 * F.col(b)
    return found.join(exact, "event_type").select(
        "event_type", "rows", "users", "events", close("user_id_count", "users").alias("users_close"), close("event_id_count", "events").alias("events_close")
    )


@register(
    "src_nested_schema",
    """select distinct 'events' as table_name, 'props.' || unnest(json_keys(props)) as column_name, 'bigint' as data_type, true as nullable from events""",
)
def src_nested_schema(s, d):
    """Fields below the JSON column as snapshot rows; all their values here are whole numbers."""
    return nested.nested_snapshot(nested.with_variant(i.table(s, d, "events"), "props"), "events", "props")


@register(
    "fn_variant_fields",
    """select event_type, count(*) as rows, count(json_extract(props, '$.k')) as k_filled, min(cast(json_extract(props, '$.k') as bigint)) as k_min,
      max(cast(json_extract(props, '$.k') as bigint)) as k_max from events group by 1""",
)
def fn_variant_fields(s, d):
    return nested.field_profile(nested.with_variant(i.table(s, d, "events"), "props"), "props", {"k": "bigint"}, ["event_type"])


STATE_COLUMNS = ["order_id", "customer_id", "total_amount"]


def _state_table(s, d):
    """Daily quality states of both layers. Bronze comes in two loads; the second reads and writes its own days only."""
    table = LakeTable(s, fresh_path(s, "quality-states"))
    raw = i.orders(s, d)
    for part in (_before(raw, "_ingestion_timestamp"), _after(raw, "_ingestion_timestamp")):
        flagged = cleaning.validate_orders(cleaning.clean_orders(part))
        quality_states.save(table, quality_states.day_states(flagged, "bronze", "_ingestion_timestamp", F.col("is_total_valid"), STATE_COLUMNS))
    staged = silver.stg_orders(raw)
    quality_states.save(table, quality_states.day_states(staged, "silver", "_ingestion_timestamp", F.col("validation_status") == "VALID", STATE_COLUMNS))
    return table


@register("quality_states_trend", QUALITY_TREND_SQL)
def quality_states_trend(s, d):
    return quality_states.trend(_state_table(s, d), ["bronze", "silver"])


def _totals_sql(layer: str, source: str, ok: str) -> str:
    parts = ", ".join(f"count({c}) as {c}_filled, {_end('min', c)} as {c}_min, {_end('max', c)} as {c}_max" for c in STATE_COLUMNS)
    return f"select '{layer}' as layer, count(*) as checks, cast(sum(coalesce(cast({ok} as integer), 0)) as bigint) as passed, {parts} from {source}"


def _end(f: str, c: str) -> str:
    return f"cast({f}({c}) as double)" if c == "total_amount" else f"{f}({c})"


@register(
    "quality_states_totals",
    query(_totals_sql("bronze", "valid_orders", "is_total_valid") + " union all " + _totals_sql("silver", "stg_orders", "(validation_status = 'VALID')"), "valid_orders", "stg_orders"),
)
def quality_states_totals(s, d):
    return quality_states.totals(_state_table(s, d), STATE_COLUMNS)
