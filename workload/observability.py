"""Registered queries over events, documents and derived metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import privacy
from granary.functions.text import cosine, word_set
from granary.operators import bronze, drift, lineage, metrics, quality, retrieval, triage, vectors
from granary.plans import gold, silver
from granary.sources import calls as call_files
from granary.sources import catalog
from granary.sources.contracts import CUSTOMERS
from workload import inputs as i
from workload.registry import register
from workload.retail import TABLE_QUALITY_SQL, _fact, _order_results, _table_quality
from workload.sql import mean, query, ratio, share, ts

NOW = i.EVENTS_NOW
DAYS = 7
SALT = "pepper"


def _calls(s, d):
    return metrics.call_cost(i.calls(s, d))


def _recent(s, d):
    return metrics.last_days(_calls(s, d), NOW, DAYS)


# -- model-call metrics ------------------------------------------------------------------------

CALL_SQL = f"""call_id, {ts("timestamp")} as timestamp, role, model, input_tokens, output_tokens, total_tokens,
  cast(latency_ms as double) as latency_ms, cast(confidence_score as double) as confidence_score, human_approved,
  cast(null as varchar) as query_type, rag_chunks_used, success, error_message, cast(cost_usd as double) as cost_usd"""
USAGE_SQL = (
    "count(*) as calls, cast(sum(total_tokens) as bigint) as tokens, cast(sum(cost_usd) as double) as cost_usd, "
    + mean("latency_ms")
    + " as avg_latency_ms"
)


@register("call_cost", query(f"select {CALL_SQL} from priced", "priced"))
def call_cost(s, d):
    return _calls(s, d)


@register("filter_timerange", query(f"select {CALL_SQL} from recent", "recent"))
def filter_timerange(s, d):
    return _recent(s, d)


@register("filter_role", query(f"select {CALL_SQL} from priced where role = 'purchase'", "priced"))
def filter_role(s, d):
    return metrics.of_role(_calls(s, d), "purchase")


SUMMARY_SQL = f"""select count(*) as total_calls, cast(coalesce(sum(total_tokens), 0) as bigint) as total_tokens,
  coalesce(cast(sum(cost_usd) as double), 0.0) as total_cost_usd, coalesce({mean("latency_ms")}, 0.0) as avg_latency_ms,
  coalesce({share("success")}, 0.0) as success_rate, {mean("confidence_score")} as avg_confidence,
  {share("human_approved")} as human_approval_rate, case when count(*) > 0 then 7 else 0 end as period_days from recent"""


@register("agg_llm_summary", query(SUMMARY_SQL, "recent"))
def agg_llm_summary(s, d):
    return metrics.call_summary(_recent(s, d), DAYS)


@register(
    "agg_llm_summary_empty",
    query(SUMMARY_SQL.replace("from recent", "from priced where timestamp > timestamp '2030-01-01'"), "priced"),
)
def agg_llm_summary_empty(s, d):
    return metrics.call_summary(metrics.last_days(_calls(s, d), "2030-06-01 00:00:00", DAYS), DAYS)


@register("agg_llm_by_role", query(f"select role, {USAGE_SQL}, {mean('confidence_score')} as avg_confidence from recent group by 1", "recent"))
def agg_llm_by_role(s, d):
    return metrics.by_role(_recent(s, d))


DAILY_SQL = f"select cast(cast(timestamp as date) as varchar) as day, {USAGE_SQL} from priced group by 1 order by 1"


FORTNIGHT_SQL = "from priced where timestamp between timestamp '2024-01-17 00:00:00' and timestamp '2024-01-31 00:00:00'"


@register("agg_llm_daily", query(DAILY_SQL.replace("from priced", FORTNIGHT_SQL), "priced"))
def agg_llm_daily(s, d):
    return metrics.daily_trend(metrics.last_days(_calls(s, d), NOW, 14))


@register("sort_day", query(DAILY_SQL, "priced"))
def sort_day(s, d):
    return metrics.daily_trend(_calls(s, d))


@register("agg_llm_cost_by_model", query("select model, role, cast(sum(cost_usd) as double) as cost_usd from recent group by 1, 2", "recent"))
def agg_llm_cost_by_model(s, d):
    return metrics.cost_by(_recent(s, d), "model", "role")


@register(
    "agg_latency_by_hour",
    query(
        f"""select cast(hour(timestamp) as integer) as hour, count(*) as calls, {mean("latency_ms")} as avg_latency_ms,
          {mean("latency_ms")} > 1500 as breach from recent group by 1""",
        "recent",
    ),
)
def agg_latency_by_hour(s, d):
    return metrics.latency_by_hour(_recent(s, d))


@register(
    "agg_confidence_hist",
    query(
        """select role, least(cast(floor(confidence_score * 20) as integer), 19) as bin, count(*) as calls from priced
        where confidence_score is not null group by 1, 2""",
        "priced",
    ),
)
def agg_confidence_hist(s, d):
    return metrics.confidence_histogram(_calls(s, d))


@register(
    "agg_confidence_range",
    query(
        f"""select role, {mean("confidence_score")} as avg_confidence, cast(min(confidence_score) as double) as min_confidence,
          cast(max(confidence_score) as double) as max_confidence from priced group by 1""",
        "priced",
    ),
)
def agg_confidence_range(s, d):
    return metrics.confidence_range(_calls(s, d))


@register(
    "agg_rag_usage",
    query(
        f"""select *, coalesce({ratio("confidence_with - confidence_without", "confidence_without", 100)}, 0.0) as improvement_pct
        from (select {mean("rag_chunks_used")} as avg_chunks, {share("rag_chunks_used > 0")} as pct_with_chunks,
            {mean("case when rag_chunks_used > 0 then confidence_score end")} as confidence_with,
            {mean("case when rag_chunks_used = 0 then confidence_score end")} as confidence_without from priced)""",
        "priced",
    ),
)
def agg_rag_usage(s, d):
    return metrics.rag_usage(_calls(s, d))


@register(
    "agg_approval_by_role",
    query(
        f"""select role, count(*) filter (where human_approved) as approved, count(*) as decided,
          {share("human_approved")} as approval_rate from priced where human_approved is not null group by rollup (role)""",
        "priced",
    ),
)
def agg_approval_by_role(s, d):
    return metrics.approval_by_role(_calls(s, d))


@register(
    "agg_calls_today",
    query(
        f"""select *, cost_usd / cast(7 as double) as cost_per_day from (
          select count(*) filter (where timestamp >= timestamp '2024-01-30 00:00:00') as calls_today, count(*) as calls,
            {ratio("sum(total_tokens)", "count(*)")} as tokens_per_call, cast(sum(cost_usd) as double) as cost_usd from recent)""",
        "recent",
    ),
)
def agg_calls_today(s, d):
    return metrics.calls_today(_recent(s, d), NOW, DAYS)


@register(
    "flag_thresholds",
    query(
        f"""select role, avg_latency_ms, success_rate, case when avg_latency_ms < 1500 then 'GOOD' else 'SLOW' end as latency_label,
          case when success_rate > 95 then 'HEALTHY' else 'REVIEW' end as success_label
        from (select role, {mean("latency_ms")} as avg_latency_ms, {share("success")} as success_rate from priced group by 1)""",
        "priced",
    ),
)
def flag_thresholds(s, d):
    per_role = _calls(s, d).groupBy("role").agg(
        metrics.mean("latency_ms").alias("avg_latency_ms"), metrics.share(F.col("success")).alias("success_rate")
    )
    return metrics.flag_thresholds(per_role)


@register(
    "win_cum_cost",
    query(
        """select cast(day as varchar) as day, cast(cost as double) as cost, cast(sum(cost) over (order by day
            rows between unbounded preceding and current row) as double) as cumulative_cost
        from (select cast(timestamp as date) as day, sum(cost_usd) as cost from priced group by 1)""",
        "priced",
    ),
)
def win_cum_cost(s, d):
    return metrics.cumulative_cost(_calls(s, d))


@register(
    "fn_json",
    query(
        f"""select call_id, {ts("timestamp")} as timestamp, role, model, total_tokens, cast(latency_ms as double) as latency_ms,
          success from calls""",
        "calls",
    ),
)
def fn_json(s, d):
    text = call_files.to_json_rows(i.calls(s, d))
    return call_files.from_json_rows(text).select(
        "call_id", "timestamp", "role", "model", "total_tokens", "latency_ms", "success"
    )


# -- pipeline runs -----------------------------------------------------------------------------

RUN_SQL = f"run_id, run_name, {ts('start')} as start, cast(duration_min as double) as duration_min, status, errors, records"
HEALTH_SQL = """case when status = 'Failed' then 'ERROR' when status = 'Warning' or errors > 0 or duration_min > 30 then 'WARNING'
  else 'HEALTHY' end"""


@register("filter_runs", query(f"select {RUN_SQL} from runs where status = 'Warning' and lower(run_name) = 'click'", "runs"))
def filter_runs(s, d):
    return metrics.filter_runs(i.runs(s, d), status="Warning", name="CLICK")


@register("run_status", query(f"select run_id, {HEALTH_SQL} as health from runs", "runs"))
def run_status(s, d):
    return i.runs(s, d).select("run_id", metrics.run_status("status", "errors", "duration_min").alias("health"))


@register(
    "agg_run_stats",
    query(
        f"""select run_name, count(*) as runs, {share("status = 'Success'")} as success_rate, {mean("duration_min")} as avg_minutes,
          cast(sum(records) as bigint) as records, count(*) filter (where duration_min > 30) as sla_breaches from runs
        where start between timestamp '2024-01-24 00:00:00' and timestamp '2024-01-31 00:00:00' group by 1""",
        "runs",
    ),
)
def agg_run_stats(s, d):
    return metrics.run_stats(i.runs(s, d), NOW, hours=24 * 7)


LATEST_SQL = f"""select run_name, start, run_id, status, errors, duration_min, records, {HEALTH_SQL} as health from (
    select *, row_number() over (partition by run_name order by start desc, run_id desc) as rn from runs) where rn = 1"""


@register(
    "win_latest_run",
    query(f"select * replace ({ts('start')} as start, cast(duration_min as double) as duration_min) from ({LATEST_SQL})", "runs"),
)
def win_latest_run(s, d):
    return metrics.latest_run(i.runs(s, d))


@register(
    "limit_history",
    query(f"select {RUN_SQL} from runs where run_name = 'purchase' order by runs.start desc, run_id desc limit 10", "runs"),
)
def limit_history(s, d):
    return metrics.recent_runs(i.runs(s, d), "purchase", 10)


@register(
    "run_audit",
    query(
        f"""select md5(cast(run_id as varchar))[1:8] as correlation_id, run_name, {ts("start")} as started_at,
          {ts("start + to_microseconds(cast(duration_min * 60000000 as bigint))")} as ended_at,
          cast(duration_min * 60 as double) as duration_seconds,
          case when status = 'Failed' then 'run ' || cast(run_id as varchar) || ' failed' end as error_message,
          case when status = 'Failed' then 'failed' else 'completed' end as outcome from runs""",
        "runs",
    ),
)
def run_audit(s, d):
    return metrics.run_audit(i.runs(s, d))


# -- drift and lineage -------------------------------------------------------------------------


def _changes(s, d):
    return drift.compare(*i.snapshots(s, d))


def _tables(s, d):
    before, after = i.snapshots(s, d)
    return before.select("table_name").unionByName(after.select("table_name"))


@register(
    "join_schema_snapshots",
    query(
        """select coalesce(e.table_name, a.table_name) as table_name, coalesce(e.column_name, a.column_name) as column_name,
          e.data_type as old_type, e.nullable as old_nullable, a.data_type as new_type, a.nullable as new_nullable
        from expected_snap e full join actual_snap a on e.table_name = a.table_name and e.column_name = a.column_name""",
        "expected_snap",
        "actual_snap",
    ),
)
def join_schema_snapshots(s, d):
    return drift.join_snapshots(*i.snapshots(s, d))


for _kind, _left, _right, _op in (
    ("added", "actual_snap", "expected_snap", "except"),
    ("removed", "expected_snap", "actual_snap", "except"),
    ("common", "expected_snap", "actual_snap", "intersect"),
):

    def _presence(s, d, kind=_kind):
        return drift.columns_by_presence(*i.snapshots(s, d)).filter(F.col("presence") == kind).drop("presence")

    register(
        f"set_columns_{_kind}",
        query(
            f"select table_name, column_name from {_left} {_op} select table_name, column_name from {_right}", _left, _right
        ),
    )(_presence)


@register("drift_compare", query("select * from changes", "changes"))
def drift_compare(s, d):
    return _changes(s, d)


@register("drift_breaking", query("select * from assessed", "assessed"))
def drift_breaking(s, d):
    return drift.assess(_changes(s, d), _tables(s, d))


@register(
    "drift_report",
    query(
        """select a.*, coalesce(l.changes, '') as changes, case when change_count = 0 then '' else coalesce(o.deps, '') end as affected,
          case when change_count = 0 then 0 else coalesce(o.n, 0) end as downstream_count,
          true as requires_human_approval,
          case when change_count = 0 then 'Nothing to do' when breaking_change then 'Hold loads that read the table until its readers fit again'
            else 'Decide whether the contract takes the new column' end as first_action
        from assessed a
        left join (select table_name, string_agg(column_name || ':' || change_type, ',' order by column_name, change_type) as changes
          from changes group by 1) l on l.table_name = a.table_name
        left join (select 't' || o_custkey as table_name, count(distinct o_orderkey) as n,
            array_to_string(list_sort(list_distinct(list('order:' || o_orderkey))), ',') as deps
          from orders group by 1) o on o.table_name = a.table_name""",
        "assessed",
    ),
)
def drift_report(s, d):
    """Dependents come from the lineage: what each customer's node reaches."""
    customers = i.table(s, d, "customer").select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("root"))
    reached = lineage.downstream(i.edges(s, d), customers)
    dependents = reached.select(F.replace("root", F.lit("customer:"), F.lit("t")).alias("table_name"), F.col("node").alias("dependent"))
    out = drift.report(_changes(s, d), _tables(s, d), dependents)
    listed = F.transform("changes", lambda c: F.concat_ws(":", c["column_name"], c["change_type"]))
    return out.select(
        "table_name", "change_count", "breaking_change", "severity", "confidence_score",
        F.coalesce(F.array_join(listed, ","), F.lit("")).alias("changes"),
        F.array_join("affected_downstream", ",").alias("affected"),
        "downstream_count",
        "requires_human_approval",
        F.element_at("recommended_actions", 1).alias("first_action"),
    )


@register(
    "drift_renamed",
    """with v as (select 'c_acctbal' as old_name, 'balance' as new_name, cast(c_acctbal as varchar) as x, cast(c_acctbal as varchar) as y from customer
        union all select 'c_name', 'full_name', cast(c_name as varchar), cast(c_name as varchar) from customer
        union all select 'c_mktsegment', 'label', cast(c_mktsegment as varchar), cast(c_name as varchar) from customer),
      o as (select distinct old_name, x from v where x is not null), n as (select distinct new_name, y from v where y is not null),
      shared as (select old_name, new_name, count(*) as k from o join n on x = y group by 1, 2),
      rated as (select s.old_name, s.new_name, k / (a.n + b.n - k) as similarity from shared s
        join (select old_name, count(*) as n from o group by 1) a using (old_name) join (select new_name, count(*) as n from n group by 1) b using (new_name))
    select 'customer' as table_name, new_name as column_name, 'RENAMED' as change_type, old_name as old_value, new_name as new_value
    from (select *, row_number() over (partition by old_name order by similarity desc, new_name) as i from rated where similarity >= 0.8) where i = 1
      and new_name <> 'label'
    union all select 'customer', 'c_mktsegment', 'COLUMN_REMOVED', 'string', null
    union all select 'customer', 'label', 'COLUMN_ADDED', null, 'string'
    union all select 'customer', 'c_nationkey', 'TYPE_CHANGED', 'int', 'bigint'""",
)
def drift_renamed(s, d):
    """The customer table against a copy in which columns have new names, or another column's values."""
    old = i.table(s, d, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("int"))
    new = old.withColumn("c_nationkey", F.col("c_nationkey").cast("long")).withColumnsRenamed({"c_acctbal": "balance", "c_name": "full_name"})
    new = new.withColumn("label", F.col("full_name")).drop("c_mktsegment")
    sides = [catalog.snapshot_of(s, {"customer": df}).select("table_name", "column_name", "data_type", F.lit(True).alias("nullable")) for df in (old, new)]
    values = [drift.value_sketches(df).withColumn("table_name", F.lit("customer")) for df in (old, new)]
    changes = drift.compare(*sides)
    return drift.with_renames(changes, drift.renamed(changes, *values))


@register("join_lineage_closure", query("select * from reached", "reached"))
def join_lineage_closure(s, d):
    return lineage.downstream(i.edges(s, d), i.roots(s, d))


@register(
    "lineage_upstream",
    query(
        """select 'order:' || o_orderkey as root, node, depth from orders join customer on c_custkey = o_custkey
          join nation on n_nationkey = c_nationkey,
          lateral (values ('customer:' || c_custkey, 1), ('nation:' || c_nationkey, 2), ('region:' || n_regionkey, 3)) v(node, depth)"""
    ),
)
def lineage_upstream(s, d):
    orders = i.table(s, d, "orders")
    return lineage.upstream(i.edges(s, d), orders.select(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("root")))


@register(
    "lineage_impact",
    query(
        """select 'region:' || r_regionkey as root, coalesce(direct, 0) as direct, coalesce(indirect, 0) as indirect,
          coalesce(max_depth, 0) as max_depth, case when coalesce(direct + indirect, 0) = 0 or direct + indirect > 10
            then 'CRITICAL' else 'HIGH' end as severity
        from region left join (select root, count(*) filter (where depth = 1) as direct,
          count(*) filter (where depth > 1) as indirect, max(depth) as max_depth from reached group by 1) x
          on x.root = 'region:' || r_regionkey""",
        "reached",
    ),
)
def lineage_impact(s, d):
    roots = i.roots(s, d)
    return lineage.impact(lineage.downstream(i.edges(s, d), roots), roots)


@register(
    "lineage_dependents",
    query(
        """select root, node, case when depth = 1 then 'direct' else 'indirect' end as relation,
          node not in (select src from edges) as end_product from reached""",
        "reached",
        "edges",
    ),
)
def lineage_dependents(s, d):
    edges = i.edges(s, d)
    return lineage.dependents(lineage.downstream(edges, i.roots(s, d)), edges)


CATALOG = ("region", "nation", "customer", "part", "orders", "lineitem", "documents", "pages", "conversations")


def _catalog_sql(name: str) -> str:
    fields = [f.split(" ") for f in i.SCHEMAS[name].split(", ")]
    rows = (
        f"select '{name}' as table_name, count(*) as rows, '{c}' as column_name, {j} as position, '{t}' as data_type, count({c}) as filled from {name}"
        for j, (c, t) in enumerate(fields, start=1)
    )
    return " union all ".join(rows)


@register("src_catalog_columns", " union all ".join(map(_catalog_sql, CATALOG)))
def src_catalog_columns(s, d):
    return catalog.column_profile(s, {t: i.table(s, d, t) for t in CATALOG})


# -- alerts and totals -------------------------------------------------------------------------


def _freshness(s, d):
    raw, items = i.orders(s, d), i.items(s, d)
    return quality.freshness(raw, "orders", "2001-09-01 06:00:00", 2, 6, "_ingestion_timestamp").unionByName(
        quality.freshness(items, "order_items", "2001-12-31 00:00:00", 24 * 30, 24 * 60, "_ingestion_timestamp")
    )


FRESH_SQL = """(select table_name, age_hours, case when age_hours > e then 'ERROR' when age_hours > w then 'WARN' else 'PASS' end as status
  from (select 'orders' as table_name, 2 as w, 6 as e, cast(epoch_us(timestamp '2001-09-01 06:00:00')
      - epoch_us(max(_ingestion_timestamp)) as double) / 3.6e9 as age_hours from raw_orders
    union all select 'order_items', 720, 1440, cast(epoch_us(timestamp '2001-12-31 00:00:00')
      - epoch_us(max(_ingestion_timestamp)) as double) / 3.6e9 from raw_items))"""


def _alerts(s, d):
    return metrics.build_alerts(
        drift=drift.assess(_changes(s, d), _tables(s, d)),
        runs=i.runs(s, d),
        rules=_order_results(s, d),
        fresh=_freshness(s, d),
    )


RULES_SQL = """(select 'orders' as table_name, rule, v as violations, case when v = 0 then 'PASS' else 'FAIL' end as status
  from (select 'total_amount_not_null' as rule, count(*) filter (where total_amount is null) as v from clean_orders
    union all select 'order_status_allowed', count(*) filter (where order_status not in
      ('PENDING','CONFIRMED','SHIPPED','DELIVERED','CANCELLED','RETURNED')) from clean_orders
    union all select 'payment_method_allowed', count(*) filter (where payment_method not in
      ('CREDIT_CARD','DEBIT_CARD','PIX','BOLETO','WALLET')) from clean_orders
    union all select 'total_calculation', count(*) filter (where not (abs(total_amount - calculated_total) < 0.01)) from clean_orders
    union all select 'order_id_unique', (select count(*) from (select 1 from clean_orders group by order_id having count(*) > 1))))"""
ALERTS_SQL = f"""
  select severity, 'Schema Drift Detected' as title, table_name as subject,
    cast(change_count as varchar) || ' schema changes in ' || table_name as description,
    'Update data contract' as recommended_action from assessed where change_count > 0
  union all select 'INFO', 'Slow Run', run_name, cast(count(*) as varchar) || ' runs of ' || run_name || ' above 30 min',
    'Review query performance' from runs where duration_min > 30 group by run_name
  union all select case status when 'FAIL' then 'CRITICAL' else 'WARNING' end, 'Quality Rule Failed', table_name || '.' || rule,
    cast(violations as varchar) || ' rows break ' || rule, 'Inspect quarantined rows' from {RULES_SQL} r where status <> 'PASS'
  union all select case status when 'ERROR' then 'ERROR' else 'WARNING' end, 'Stale Table', table_name,
    table_name || ' is stale', 'Check the ingestion run' from {FRESH_SQL} f where status <> 'PASS'"""
ALERT_CTES = ("assessed", "runs", "clean_orders", "raw_orders", "raw_items")


@register("alert_build", query(ALERTS_SQL, *ALERT_CTES))
def alert_build(s, d):
    return _alerts(s, d)


@register(
    "agg_alert_counts",
    query(
        f"""select count(*) as alerts, count(*) filter (where severity = 'CRITICAL') as critical_count,
          count(*) filter (where severity = 'ERROR') as error_count, count(*) filter (where severity = 'WARNING') as warning_count,
          count(*) filter (where severity = 'INFO') as info_count from ({ALERTS_SQL}) a""",
        *ALERT_CTES,
    ),
)
def agg_alert_counts(s, d):
    return metrics.alert_counts(_alerts(s, d))


@register(
    "agg_platform_kpis",
    query(
        f"""with q as (select count(*) as n, {ratio("sum(cast(round(quality_score, 6) as decimal(12,6)) * row_count)", "sum(row_count)")} as score
            from ({TABLE_QUALITY_SQL}) t),
          r as (select count(*) as n, count(*) filter (where health = 'HEALTHY') as ok from ({LATEST_SQL}) l)
        select (select count(*) from fact_sales) as total_records, q.n as tables_monitored, r.ok as healthy_runs, r.n as total_runs,
          {ratio("r.ok", "r.n", 100)} as health_pct, q.score as quality_score, (select min(age_hours) from {FRESH_SQL} f) as freshness_hours,
          (select min(age_hours) from {FRESH_SQL} f) < 2 as is_fresh, (select count(*) from ({ALERTS_SQL}) a) as open_alerts from q, r""",
        *ALERT_CTES,
        "raw_customers",
        "fact_sales",
    ),
)
def agg_platform_kpis(s, d):
    return metrics.platform_kpis(
        _fact(s, d), _table_quality(s, d), metrics.latest_run(i.runs(s, d)), _freshness(s, d), _alerts(s, d)
    )


# -- privacy -----------------------------------------------------------------------------------

EMAIL_RE = r"(?i)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_RE = r"\b(?:\+55\s?)?\(?\d{2}\)?\s?\d{4,5}[-.\s]?\d{4}\b"
CPF_RE = r"\b\d{3}\.?\d{3}\.?\d{3}[-.]?\d{2}\b"
CARD_RE = r"\b(?:\d{4}[-.\s]?){3}\d{4}\b"
IP_RE = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"


def _generic(m, start, end):
    c = f"regexp_replace({m}, '[^A-Za-z0-9]', '', 'g')"
    tail = f" || right({c}, {end})" if end else ""
    return (
        f"case when length({c}) <= {start + end} then repeat('*', length({m})) "
        f"else left({c}, {start}) || repeat('*', length({c}) - {start + end}){tail} end"
    )


EMAIL_MASK = """case when strpos(m, '@') > 2 then m[1] || '***' else '***' end || '@'
  || case when length(string_split(string_split(m, '@')[2], '.')[1]) > 1 then string_split(m, '@')[2][1] || '***' else '***' end
  || '.' || array_to_string(string_split(string_split(m, '@')[2], '.')[2:], '')"""
CARD_MASK = "'**** **** **** ' || right(regexp_replace(m, '[^0-9]', '', 'g'), 4)"


def _mask_step(source, column, pattern, mask):
    """Alternate the parts between matches with the masked matches."""
    return f"""select * replace (array_to_string(list_transform(list_zip(regexp_split_to_array({column}, '{pattern}'),
        list_transform(regexp_extract_all({column}, '{pattern}'), lambda m: {mask})), lambda p: p[1] || coalesce(p[2], '')), '')
      as {column}) from ({source})"""


def _masked_sql(source, column):
    out = source
    for pattern, mask in (
        (EMAIL_RE, EMAIL_MASK),
        (PHONE_RE, _generic("m", 3, 2)),
        (CPF_RE, _generic("m", 3, 2)),
        (CARD_RE, CARD_MASK),
        (IP_RE, _generic("m", 3, 0)),
    ):
        out = _mask_step(out, column, pattern, mask)
    return out


# a customer-service text per customer with mail, phone, address and account number
NOTE_SQL = """select c_custkey, 'Write to ' || replace(c_name, '#', '.') || '@' || lower(c_mktsegment) || '.example.com.br or call (11) 9'
    || lpad(cast(c_custkey % 10000 as varchar), 4, '0') || '-' || lpad(cast(c_custkey * 7 % 10000 as varchar), 4, '0')
    || ', host 10.' || cast(c_nationkey as varchar) || '.0.' || cast(c_custkey % 250 as varchar) || ', card 4111-'
    || lpad(cast(c_custkey % 10000 as varchar), 4, '0') || '-3333-' || lpad(cast(c_custkey * 3 % 10000 as varchar), 4, '0')
    || ', cpf 123.' || lpad(cast(c_custkey % 1000 as varchar), 3, '0') || '.789-00' as text from customer"""


def _notes(s, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    text = F.concat(
        F.lit("Write to "), F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.lit("@"), F.lower("c_mktsegment"),
        F.lit(".example.com.br or call (11) 9"), i.pad(k % 10000, 4), F.lit("-"), i.pad(k * 7 % 10000, 4),
        F.lit(", host 10."), n.cast("string"), F.lit(".0."), (k % 250).cast("string"),
        F.lit(", card 4111-"), i.pad(k % 10000, 4), F.lit("-3333-"), i.pad(k * 3 % 10000, 4),
        F.lit(", cpf 123."), i.pad(k % 1000, 3), F.lit(".789-00"),
    )
    return i.table(s, d, "customer").select("c_custkey", text.alias("text"))


@register("pii_mask_text", f"select c_custkey, text from ({_masked_sql(NOTE_SQL, 'text')})")
def pii_mask_text(s, d):
    return _notes(s, d).withColumn("text", privacy.mask_text("text"))


@register("pii_mask_documents", f"select doc_id, text from ({_masked_sql('select doc_id, text from documents', 'text')})")
def pii_mask_documents(s, d):
    return i.table(s, d, "documents").select("doc_id", privacy.mask_text("text").alias("text"))


@register("pii_hash", f"select c_custkey, sha256('{SALT}' || c_name)[1:16] as pseudonym from customer")
def pii_hash(s, d):
    return i.table(s, d, "customer").select("c_custkey", privacy.hash_pii("c_name", SALT).alias("pseudonym"))


PARTIAL = {c: _generic(c, 3, 2) for c in ("first_name", "last_name", "phone")}
MASKED_SQL = f"""{PARTIAL["first_name"]} as first_name, {PARTIAL["last_name"]} as last_name,
  case when email is not null then sha256('{SALT}' || email)[1:16] end as email, {PARTIAL["phone"]} as phone,
  case when address_line1 is not null then '********' end as address_line1"""


@register("pii_mask_columns", query(f"select customer_id, {ts('updated_at')} as updated_at, {MASKED_SQL} from raw_customers", "raw_customers"))
def pii_mask_columns(s, d):
    out = privacy.mask_columns(i.customers(s, d), CUSTOMERS, SALT)
    return out.select("customer_id", "updated_at", "first_name", "last_name", "email", "phone", "address_line1")


@register("mask_gold_view", query(f"select dim_customer_key, region, customer_segment, {MASKED_SQL} from dim_customer", "dim_customer"))
def mask_gold_view(s, d):
    dim = gold.dim_customer(silver.stg_customers(i.customers(s, d)), i.RETAIL_TODAY)
    return privacy.mask_columns(dim, CUSTOMERS, SALT).select(
        "dim_customer_key", "region", "customer_segment", "first_name", "last_name", "email", "phone", "address_line1"
    )


SCAN_PATTERNS = {"email": EMAIL_RE, "phone_br": PHONE_RE, "cpf": CPF_RE, "credit_card": CARD_RE, "ip_address": IP_RE}


def _scan_sql(table, column):
    return " union all ".join(
        f"""select '{table}' as table_name, '{column}' as column_name, '{n}' as pattern,
          cast(coalesce(sum(len(regexp_extract_all({column}, '{p}'))), 0) as bigint) as hits,
          count(*) filter (where len(regexp_extract_all({column}, '{p}')) > 0) as rows_hit from {table}"""
        for n, p in SCAN_PATTERNS.items()
    )


@register("pii_scan", _scan_sql("documents", "text") + " union all " + _scan_sql("conversations", "text"))
def pii_scan(s, d):
    a = privacy.scan(i.table(s, d, "documents"), ["text"], "documents")
    return a.unionByName(privacy.scan(i.table(s, d, "conversations"), ["text"], "conversations"))


@register(
    "fn_map_mask",
    query(
        f"""select c_custkey, 'text=' || text || ';api_key=********;segment=' || c_mktsegment as entries
        from ({_masked_sql(NOTE_SQL, "text")}) join (select c_custkey as k, c_mktsegment from customer) on k = c_custkey"""
    ),
)
def fn_map_mask(s, d):
    notes = _notes(s, d).join(i.table(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")
    entries = F.create_map(
        F.lit("text"), F.col("text"), F.lit("api_key"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")
    )
    wide = notes.select("c_custkey", entries.alias("m"))
    masked = wide.withColumn("m", privacy.mask_nested(F.col("m"), wide.schema["m"].dataType))
    pairs = F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return masked.select("c_custkey", F.array_join(pairs, ";").alias("entries"))


# -- triage ------------------------------------------------------------------------------------

TYPE_SQL = """case when regexp_matches(lower(text), 'schema|column|drift') then 'SchemaDrift'
  when regexp_matches(lower(text), 'connection|refused|timeout') then 'ConnectionFailure'
  when regexp_matches(lower(text), 'null|quality|validation') then 'DataQuality' else 'Unknown' end"""
IMPACT_SQL = """case error_type when 'SchemaDrift' then 'MEDIUM' when 'ConnectionFailure' then 'HIGH' when 'DataQuality' then 'HIGH'
  else 'MEDIUM' end as business_impact, case error_type when 'SchemaDrift' then 'bronze.customers,silver.stg_customers'
  when 'ConnectionFailure' then 'bronze.customers,bronze.products,bronze.stores' when 'DataQuality' then 'bronze.orders'
  else '' end as affected_tables, cast(case error_type when 'SchemaDrift' then 0.85 when 'ConnectionFailure' then 0.90
  when 'DataQuality' then 0.88 else 0.30 end as double) as confidence_score"""
SIGNATURE_SQL = r"""lower(trim(regexp_replace(regexp_replace(regexp_replace(text, '''[^'']*''|"[^"]*"', '<q>', 'g'),
  '[0-9]+', '<n>', 'g'), '\s+', ' ', 'g')))"""


@register(
    "triage_errors",
    query(f"select log_id, error_type, {IMPACT_SQL}, true as requires_human_approval from (select *, {TYPE_SQL} as error_type from logs)", "logs"),
)
def triage_errors(s, d):
    out = triage.triage(i.logs(s, d))
    return out.select(
        "log_id", "error_type", "business_impact", F.array_join("affected_tables", ",").alias("affected_tables"),
        "confidence_score", "requires_human_approval",
    )


@register(
    "agg_error_groups",
    query(
        f"""select signature, error_type, count(*) as occurrences, min(log_id) as first_id, max(log_id) as last_id
        from (select log_id, {SIGNATURE_SQL} as signature, {TYPE_SQL} as error_type from logs) group by 1, 2""",
        "logs",
    ),
)
def agg_error_groups(s, d):
    return triage.error_groups(i.logs(s, d)).select("signature", "error_type", "occurrences", "first_id", "last_id")


def _templates_sql(source: str, text: str, key: str) -> str:
    """Length and two lead tokens make a leaf; positions with digits or more than eight tokens vary."""
    return rf"""select * from (with t as (select {key} as id, list_filter(regexp_split_to_array(coalesce({text}, ''), '\s+'), lambda w: w <> '') as w from {source}),
      l as (select *, len(w) as n, array_to_string(list_transform(w[:2], lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end), ' ') as lead from t),
      p as (select n, lead, unnest(range(1, n + 1)) as i, unnest(w) as x from l),
      v as (select n, lead, list(i) as vary from (select n, lead, i from p group by 1, 2, 3 having count(distinct x) > 8 or bool_or(regexp_matches(x, '[0-9]'))) group by 1, 2),
      s as (select id, array_to_string(list_transform(w, lambda x, i: case when list_contains(coalesce(vary, []), i) then '<*>' else x end), ' ') as template
        from l left join v using (n, lead))
      select template, count(*) as occurrences, min(id) as first_id, max(id) as last_id from s group by 1)"""


@register("error_templates", query(_templates_sql("logs", "text", "log_id"), "logs"))
def error_templates(s, d):
    return triage.error_templates(i.logs(s, d))


@register("text_templates", _templates_sql("conversations", "text", "conv_id"))
def text_templates(s, d):
    """The same over free text, where most leaves are small."""
    return triage.error_templates(i.table(s, d, "conversations"), "text", "conv_id")


@register(
    "triage_batch",
    query(
        f"""select log_id, error_type, count(*) over (partition by signature, error_type) as occurrences, {IMPACT_SQL}
        from (select log_id, {SIGNATURE_SQL} as signature, {TYPE_SQL} as error_type from logs)""",
        "logs",
    ),
)
def triage_batch(s, d):
    out = triage.triage_batch(i.logs(s, d))
    return out.select(
        "log_id", "error_type", "occurrences", "business_impact",
        F.array_join("affected_tables", ",").alias("affected_tables"), "confidence_score",
    )


@register(
    "triage_with_context",
    query(
        rf"""select q.query_id as log_id, error_type, {IMPACT_SQL}, coalesce(c.chunks, 0) as chunks, coalesce(c.tokens, 0) as estimated_tokens
        from (select *, {TYPE_SQL.replace("text", "query")} as error_type from (select distinct query_id, query from routed)) q
        left join (select query_id, count(*) as chunks, cast(floor(sum(length(content)) / 4) as bigint) as tokens
          from ranked join chunks using (chunk_id) group by 1) c on c.query_id = q.query_id""",
        "ranked",
        "routed",
        "chunks",
    ),
)
def triage_with_context(s, d):
    errors = i.questions(s, d).withColumnsRenamed({"query_id": "log_id", "query": "text"})
    out = triage.triage_with_context(errors, i.chunks(s, d))
    return out.select(
        "log_id", "error_type", "business_impact", F.array_join("affected_tables", ",").alias("affected_tables"),
        "confidence_score", "chunks", "estimated_tokens",
    )


# -- retrieval ---------------------------------------------------------------------------------


@register("rag_classify", query("select distinct query_id, query_type from routed", "routed"))
def rag_classify(s, d):
    return i.questions(s, d).select("query_id", retrieval.classify("query").alias("query_type"))


@register(
    "join_query_chunks",
    query(
        """select query_id, query_type, chunk_type, position, candidates, characters from routed
        join (select chunk_type as t, count(*) as candidates, cast(sum(length(content)) as bigint) as characters from chunks group by 1)
          on t = chunk_type""",
        "routed",
        "chunks",
    ),
)
def join_query_chunks(s, d):
    return retrieval.candidates(i.questions(s, d), i.chunks(s, d))


def _ranked(s, d):
    return retrieval.rank_keyword(i.questions(s, d), i.chunks(s, d))


@register("rag_rank_keyword", query("select * from ranked", "ranked"))
def rag_rank_keyword(s, d):
    return _ranked(s, d)


@register("win_top_k_chunks", query("select query_id, chunk_id, rank from ranked", "ranked"))
def win_top_k_chunks(s, d):
    return _ranked(s, d).select("query_id", "chunk_id", "rank")


@register("topk_chunks", query("select query_id, chunk_id, score from ranked where rank <= 3", "ranked"))
def topk_chunks(s, d):
    return retrieval.rank_keyword(i.questions(s, d), i.chunks(s, d), k=3).select("query_id", "chunk_id", "score")


@register(
    "rag_context_build",
    query(
        r"""select query_id, query_type, count(*) as chunks, cast(floor(sum(length(content)) / 4) as bigint) as estimated_tokens,
          md5(string_agg('[' || cast(rank as varchar) || '] Source: ' || source || chr(10) || 'Type: ' || chunk_type || chr(10)
            || 'Content:' || chr(10) || content || chr(10), chr(10) || '---' || chr(10) order by rank)) as context_md5
        from ranked join chunks using (chunk_id) group by 1, 2""",
        "ranked",
        "chunks",
    ),
)
def rag_context_build(s, d):
    chunks = i.chunks(s, d)
    out = retrieval.build_context(retrieval.rank_keyword(i.questions(s, d), chunks), chunks)
    return out.withColumn("context_md5", F.md5("context")).drop("context")


@register(
    "rag_rank_embedding",
    """with v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
      cells as (select label, unnest(e) as x, unnest(range(1, len(e) + 1)) as i from v),
      means as (select label, i, avg(x) as m from cells group by 1, 2),
      cent as (select label, list(m order by i) as c from means group by 1)
    select cast(label as bigint) as query_id, vec_id as chunk_id, round(sim, 6) as similarity, cast(rank as integer) as rank
    from (select cent.label, vec_id, list_dot_product(e, c) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(c, c))) as sim,
        row_number() over (partition by cent.label order by sim desc, vec_id) as rank from cent, v) where rank <= 5""",
)
def rag_rank_embedding(s, d):
    vecs = i.vectors(s, d)
    out = retrieval.rank_embedding(i.centroids(vecs), vecs.select("chunk_id", "embedding"))
    return out.withColumn("similarity", F.round("similarity", 6))


VECTORS_SQL = """with v as (select vec_id, cast(embedding as double[]) as e from embeddings),
      q as (select vec_id as query_id, e as c from v where vec_id % 100 = 0)
    select query_id, vec_id as chunk_id, round(sim, 6) as similarity, cast(rank as integer) as rank
    from (select query_id, vec_id, list_dot_product(e, c) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(c, c))) as sim,
        row_number() over (partition by query_id order by sim desc, vec_id) as rank from q, v) where rank <= 5"""


@register("rag_rank_vectors", VECTORS_SQL)
def rag_rank_vectors(s, d):
    vecs = i.vectors(s, d).select("chunk_id", "embedding")
    asked = vecs.where("chunk_id % 100 = 0").withColumnRenamed("chunk_id", "query_id")
    return retrieval.rank_embedding(asked, vecs).withColumn("similarity", F.round("similarity", 6))


@register("rag_index_vectors", VECTORS_SQL)
def rag_index_vectors(s, d):
    """The same answers from the index."""
    vecs = i.vectors(s, d).select("chunk_id", "embedding")
    asked = vecs.where("chunk_id % 100 = 0").withColumnRenamed("chunk_id", "query_id")
    return vectors.search(vectors.build(vecs), asked, retrieval.MAX_CHUNKS).withColumn("similarity", F.round("similarity", 6))


@register(
    "fn_cosine",
    """with v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
      cells as (select label, unnest(e) as x, unnest(range(1, len(e) + 1)) as i from v),
      means as (select label, i, avg(x) as m from cells group by 1, 2),
      cent as (select label, list(m order by i) as c from means group by 1)
    select vec_id, round(list_dot_product(e, c) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(c, c))), 6) as to_centroid
    from v join cent on v.label = cent.label""",
)
def fn_cosine(s, d):
    vecs = i.vectors(s, d)
    cent = i.centroids(vecs).select("query_id", F.col("embedding").alias("c"))
    joined = vecs.join(cent, F.col("label") == F.col("query_id"))
    return joined.select(F.col("chunk_id").alias("vec_id"), F.round(cosine("embedding", "c"), 6).alias("to_centroid"))


@register(
    "fn_word_overlap",
    r"""select conv_id, turn, len(list_filter(list_distinct(regexp_split_to_array(lower(text), '\s+')), lambda w: w <> '')) as words,
      cast(len(list_intersect(list_distinct(regexp_split_to_array(lower(text), '\s+')), ['the', 'of', 'de', 'la', 'und'])) as integer) as common
    from conversations""",
)
def fn_word_overlap(s, d):
    words = word_set("text")
    common = F.array(*[F.lit(w) for w in ("the", "of", "de", "la", "und")])
    return i.table(s, d, "conversations").select(
        "conv_id",
        "turn",
        F.size(words).cast("long").alias("words"),
        F.size(F.array_intersect(words, common)).alias("common"),
    )


@register(
    "set_union_chunks",
    """select 'contract' as chunk_type, count(*) as chunks, cast(sum(length(text)) as bigint) as characters from documents
    union all select 'manifest', count(*), cast(sum(length(html)) as bigint) from pages
    union all select 'error_pattern', count(*), cast(sum(length(text)) as bigint) from conversations""",
)
def set_union_chunks(s, d):
    docs = i.table(s, d, "documents").select(F.lit("contract").alias("chunk_type"), F.col("text").alias("content"))
    pages = i.table(s, d, "pages").select(F.lit("manifest").alias("chunk_type"), F.col("html").alias("content"), "url")
    talk = i.table(s, d, "conversations").select(F.lit("error_pattern").alias("chunk_type"), F.col("text").alias("content"))
    every = retrieval.union_sources(docs, pages, talk)
    return every.groupBy("chunk_type").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum(F.length("content")).alias("characters")
    )


@register(
    "with_audit",
    "select event_id, '2024-01-31 00:00:00' as _loaded_at, 'run-1' as _run_id, 'bronze.events' as _model from events",
)
def with_audit(s, d):
    loaded = F.lit(NOW).cast("timestamp")
    return bronze.with_audit(i.table(s, d, "events").select("event_id"), "run-1", "bronze.events", loaded)
