"""Registered queries over the retail tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from granary.functions.keys import surrogate_key
from granary.operators import bronze, cleaning, dedup, quality, scd2
from granary.session import discard, materialize, stage
from granary.plans import analytics, gold, silver
from granary.sources.contracts import CUSTOMERS, ORDERS
from workload import inputs as i
from workload.registry import register
from workload.sql import CUSTOMER_HASH, dbl, key, query, ratio, share, ts

TODAY = i.RETAIL_TODAY


# the feeds have one row per customer and year, or product and month, so no key can be hot


def _customers(s, d):
    return silver.stg_customers(i.customers(s, d), split_rows=None)


def _products(s, d):
    return silver.stg_products(i.products(s, d), split_rows=None)


def _orders(s, d):
    return silver.stg_orders(i.orders(s, d))


def _items(s, d):
    return dedup.dedup_latest(i.items(s, d), ["order_item_id"], ["_ingestion_timestamp"])


def _dim_customer(s, d):
    return gold.dim_customer(_customers(s, d), TODAY)


def _dim_product(s, d):
    return gold.dim_product(_products(s, d), TODAY)


def _spine(s, d):
    bounds = i.table(s, d, "orders").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return gold.date_spine(bounds)


def _dim_date(s, d):
    return gold.build_dim_date(_spine(s, d), TODAY, fiscal_start_month=7)


def _lines(s, d):
    return gold.order_lines(_items(s, d), _orders(s, d))


def _fact(s, d, cost="current"):
    return gold.fact_sales(_items(s, d), _orders(s, d), _products(s, d), cost)


def _written(df, name):
    """A dimension as a table of its own: later joins know its size before they run, and broadcast it if it is small."""
    return materialize(df, name)


def _order_facts(s, d, cost=False):
    products = _written(scd2.current_only(_products(s, d)), "products") if cost else None
    return gold.order_facts(_items(s, d), _orders(s, d), products)


# -- sources, row steps ------------------------------------------------------------------------


@register(
    "src_table",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    + ts("o_orderdate")
    + " as o_orderdate, o_orderpriority from orders",
)
def src_table(s, d):
    return i.table(s, d, "orders")


@register("src_date_spine", query("select cast(d as varchar) as calendar_date from spine", "spine"))
def src_date_spine(s, d):
    return _spine(s, d)


@register(
    "stamp_metadata",
    "select c_custkey, c_name, '2024-01-02 03:04:05' as _ingestion_timestamp, 'crm' as _source_system, "
    "'b1' as _batch_id, cast(null as varchar) as _file_path, '2024-01-02' as _ingestion_date from customer",
)
def stamp_metadata(s, d):
    df = i.table(s, d, "customer").select("c_custkey", "c_name")
    return bronze.stamp_metadata(df, "crm", "b1", datetime(2024, 1, 2, 3, 4, 5))


ORDER_RAW_SQL = (
    "order_id, customer_id, " + ts("order_date") + " as order_date, order_status, shipping_address, payment_method, "
    + dbl("subtotal", "discount_amount", "shipping_cost", "total_amount") + ", " + ts("created_at") + " as created_at, "
    + ts("updated_at") + " as updated_at"
)


@register(
    "enforce_schema",
    query(f"select {ORDER_RAW_SQL}, {ts('_ingestion_timestamp')} as _ingestion_timestamp from raw_orders", "raw_orders"),
)
def enforce_schema(s, d):
    return bronze.enforce_schema(i.orders(s, d), ORDERS.schema())


@register(
    "apply_contract",
    query(
        f"""select customer_id, first_name, last_name, email, phone, address_line1, city, state, postal_code,
          coalesce(country_code, 'BR') as country_code, customer_segment,
          case when registration_date >= date '1995-02-01' then cast(registration_date as varchar) end as registration_date,
          coalesce(is_active, true) as is_active, {ts("created_at")} as created_at, {ts("updated_at")} as updated_at,
          case when registration_date >= date '1995-02-01' then '' else 'registration_date' end as cast_failures
        from raw_customers""",
        "raw_customers",
    ),
)
def apply_contract(s, d):
    raw = i.customers(s, d).drop("_ingestion_timestamp")
    early = F.col("registration_date") < "1995-02-01"
    text = F.when(early, F.lit("not a date")).otherwise(F.col("registration_date").cast("string"))
    out = bronze.apply_contract(raw.withColumn("registration_date", text), CUSTOMERS)
    return out.withColumn("cast_failures", F.array_join("_cast_failures", ",")).drop("_cast_failures")


CLEAN_CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone", "address_line1", "city", "state", "postal_code",
    "country_code", "customer_segment", "is_active",
]
CUSTOMER_TIMES_SQL = (
    "cast(registration_date as varchar) as registration_date, "
    + ts("source_created_at") + " as source_created_at, " + ts("source_updated_at") + " as source_updated_at"
)


@register(
    "clean_customers",
    query(f"select {', '.join(CLEAN_CUSTOMER_COLUMNS)}, {CUSTOMER_TIMES_SQL} from clean_customers", "clean_customers"),
)
def clean_customers(s, d):
    return cleaning.clean_customers(i.customers(s, d)).drop("_ingestion_timestamp")


ORDER_MONEY_SQL = dbl("subtotal", "discount_amount", "shipping_cost", "total_amount", "calculated_total")


@register(
    "clean_orders",
    query(
        f"""select order_id, customer_id, {ts("order_date")} as order_date, order_status, shipping_address, payment_method,
          {ORDER_MONEY_SQL} from clean_orders""",
        "clean_orders",
    ),
)
def clean_orders(s, d):
    return cleaning.clean_orders(i.orders(s, d)).drop("source_created_at", "source_updated_at", "_ingestion_timestamp")


@register(
    "validate_orders",
    query(
        f"""select order_id, {ts("source_updated_at")} as source_updated_at, is_total_valid, is_status_valid,
          is_payment_valid, validation_status from valid_orders""",
        "valid_orders",
    ),
)
def validate_orders(s, d):
    out = cleaning.validate_orders(cleaning.clean_orders(i.orders(s, d)))
    return out.select(
        "order_id", "source_updated_at", "is_total_valid", "is_status_valid", "is_payment_valid", "validation_status"
    )


DERIVED = [
    "order_id", "total_amount", "discount_percentage", "order_date_key",
    "order_year", "order_month", "order_day", "order_day_of_week",
]


@register(
    "derive_order_fields",
    query(
        """select order_id, cast(total_amount as double) as total_amount, discount_percentage,
          cast(order_date_key as varchar) as order_date_key, order_year, order_month, order_day, order_day_of_week
        from stg_orders""",
        "stg_orders",
    ),
)
def derive_order_fields(s, d):
    flagged = cleaning.validate_orders(cleaning.clean_orders(i.orders(s, d)))
    return cleaning.derive_order_fields(silver.latest_orders(flagged)).select(*DERIVED)


PRODUCT_SQL = (
    "product_id, product_name, category_id, category_name, subcategory_name, brand, stock_quantity, is_active, "
    "margin_percentage, price_tier, stock_status, "
    + dbl("unit_price", "unit_cost", "unit_margin")
    + ", " + ts("source_created_at") + " as source_created_at, " + ts("source_updated_at") + " as source_updated_at"
)


@register("enrich_products", query(f"select {PRODUCT_SQL} from clean_products", "clean_products"))
def enrich_products(s, d):
    return cleaning.enrich_products(cleaning.clean_products(i.products(s, d))).drop("_ingestion_timestamp")


ENRICHED_CUSTOMER = [
    "customer_id", "full_name", "tenure_days", "tenure_years", "tenure_segment", "region", "segment_rank",
    "status_description",
]


@register(
    "enrich_dim_customer", query(f"select {', '.join(ENRICHED_CUSTOMER)} from dim_customer", "dim_customer")
)
def enrich_dim_customer(s, d):
    current = scd2.current_only(_customers(s, d))
    return gold.enrich_dim_customer(current, TODAY).select(*ENRICHED_CUSTOMER)


@register(
    "enrich_dim_product",
    query(
        f"""select product_id, category_path, margin_band, {dbl("inventory_value", "inventory_retail_value")},
          days_in_catalog, product_lifecycle_stage, product_status from dim_product""",
        "dim_product",
    ),
)
def enrich_dim_product(s, d):
    current = scd2.current_only(_products(s, d))
    return gold.enrich_dim_product(current, TODAY).select(
        "product_id", "category_path", "margin_band", "inventory_value", "inventory_retail_value",
        "days_in_catalog", "product_lifecycle_stage", "product_status",
    )


DATE_SQL = """select * replace (cast(calendar_date as varchar) as calendar_date,
  cast(week_start_date as varchar) as week_start_date, cast(week_end_date as varchar) as week_end_date,
  cast(month_start_date as varchar) as month_start_date, cast(month_end_date as varchar) as month_end_date) from dim_date"""


@register("build_dim_date", query(DATE_SQL, "dim_date"))
def build_dim_date(s, d):
    return _dim_date(s, d)


ENRICHED_FACT = [
    "order_item_id", "gross_revenue", "discount_amount", "cost_of_goods_sold", "gross_profit", "margin_percentage",
    "order_date_only", "order_hour",
]


@register(
    "enrich_fact",
    query(
        f"""select order_item_id, {dbl("gross_revenue", "discount_amount", "cost_of_goods_sold", "gross_profit")},
          margin_percentage, cast(order_date_only as varchar) as order_date_only, order_hour from fact_sales""",
        "fact_sales",
    ),
)
def enrich_fact(s, d):
    lines = _lines(s, d)
    return gold.enrich_fact(gold.with_product(lines, _products(s, d))).select(*ENRICHED_FACT)


@register(
    "filter_watermark_source",
    query(f"select {ORDER_RAW_SQL} from raw_orders where updated_at > timestamp '1999-06-01 00:00:00'", "raw_orders"),
)
def filter_watermark_source(s, d):
    return bronze.after_watermark(i.orders(s, d), "updated_at", datetime(1999, 6, 1)).drop("_ingestion_timestamp")


@register(
    "filter_incremental",
    query(
        """select order_id, order_status from raw_orders where _ingestion_timestamp > (select
          coalesce(max(_ingestion_timestamp), timestamp '1900-01-01') from raw_orders where order_date < timestamp '2000-01-01')""",
        "raw_orders",
    ),
)
def filter_incremental(s, d):
    raw = i.orders(s, d)
    done = raw.filter(F.col("order_date") < F.lit("2000-01-01").cast("timestamp"))
    return bronze.incremental(raw, done).select("order_id", "order_status")


@register(
    "filter_current",
    query("select customer_id, customer_segment from stg_customers where is_current", "stg_customers"),
)
def filter_current(s, d):
    return scd2.current_only(_customers(s, d)).select("customer_id", "customer_segment")


# -- joins -------------------------------------------------------------------------------------


@register(
    "join_order_lines",
    query(
        f"""select order_item_id, order_id, product_id, quantity, customer_id, {ts("order_date")} as order_date,
          cast(order_date_key as varchar) as order_date_key, order_status, payment_method, validation_status,
          {dbl("line_unit_price", "line_discount_percent", "line_total", "shipping_cost", "order_total")} from lines""",
        "lines",
    ),
)
def join_order_lines(s, d):
    return _lines(s, d)


@register(
    "join_fact_product",
    query(
        "select order_item_id, product_id, cast(unit_cost as double) as product_unit_cost, category_name, "
        "subcategory_name, brand from fact_sales",
        "fact_sales",
    ),
)
def join_fact_product(s, d):
    lines = _lines(s, d)
    return gold.with_product(lines, _products(s, d)).select(
        "order_item_id", "product_id", "product_unit_cost", "category_name", "subcategory_name", "brand"
    )


@register(
    "join_change_detect",
    query(
        f"""with old as (select customer_id as k, {key(*CUSTOMER_HASH)} as h, row_number() over (partition by customer_id
            order by source_updated_at desc) as rn from clean_customers where source_updated_at < timestamp '1999-01-01'),
          new as (select customer_id, {ts("source_updated_at")} as source_updated_at, {key(*CUSTOMER_HASH)} as row_hash
            from clean_customers where source_updated_at >= timestamp '1999-01-01')
        select customer_id, source_updated_at, case when k is null then 'INSERT' when row_hash <> h then 'UPDATE'
          else 'NO_CHANGE' end as change_type from new left join old on k = customer_id and rn = 1""",
        "clean_customers",
    ),
)
def join_change_detect(s, d):
    clean = cleaning.clean_customers(i.customers(s, d))
    cut = F.lit("1999-01-01").cast("timestamp")
    before = clean.filter(F.col("source_updated_at") < cut)
    current = dedup.dedup_latest(before, ["customer_id"], ["source_updated_at"])
    incoming = clean.filter(F.col("source_updated_at") >= cut)
    out = scd2.detect_changes(incoming, current, "customer_id", scd2.CUSTOMER_TRACKED)
    return out.select("customer_id", "source_updated_at", "change_type")


#: Items whose order went astray: a fixed share of them points to an order that does not exist.
STRAY_ITEMS = """(select * replace (case when quantity % 7 = 0 then 'LOST-' || order_id else order_id end as order_id)
          from raw_items)"""


def _stray_items(s, d):
    lost = F.when(F.col("quantity") % 7 == 0, F.concat(F.lit("LOST-"), "order_id")).otherwise(F.col("order_id"))
    return i.items(s, d).withColumn("order_id", lost)


@register(
    "join_valid_orders",
    query(
        f"""select order_item_id, order_id, cast(line_total as double) as line_total from {STRAY_ITEMS} where order_id in
          (select order_id from raw_orders)""",
        "raw_items",
        "raw_orders",
    ),
)
def join_valid_orders(s, d):
    valid, _ = quality.split_orphans(_stray_items(s, d), i.orders(s, d))
    return valid.select("order_item_id", "order_id", "line_total")


@register(
    "join_orphans",
    query(
        f"""select order_item_id, order_id, cast(line_total as double) as line_total from {STRAY_ITEMS} where order_id not in
          (select order_id from raw_orders)""",
        "raw_items",
        "raw_orders",
    ),
)
def join_orphans(s, d):
    _, orphan = quality.split_orphans(_stray_items(s, d), i.orders(s, d))
    return orphan.select("order_item_id", "order_id", "line_total")


@register(
    "join_relationship_test",
    query(
        f"""select order_id, count(*) as n_lines from {STRAY_ITEMS} where order_id not in
          (select order_id from raw_orders) group by 1""",
        "raw_items",
        "raw_orders",
    ),
)
def join_relationship_test(s, d):
    broken = quality.orphans(_stray_items(s, d), i.orders(s, d), "order_id", "order_id")
    return broken.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"))


STAR_SQL = """select f.order_item_id, c.customer_segment, c.region, p.price_tier, p.margin_band, d.year, d.quarter,
    cast(f.net_revenue as double) as net_revenue
  from fact_sales f join dim_customer c on c.dim_customer_key = f.dim_customer_key
  join dim_product p on p.dim_product_key = f.dim_product_key join dim_date d on d.date_key = f.dim_date_key"""


@register("join_star", query(STAR_SQL, "fact_sales", "dim_customer", "dim_product", "dim_date"))
def join_star(s, d):
    products = stage(scd2.current_only(_products(s, d)), "products")
    dimensions = [stage(x, "dimension") for x in (_dim_customer(s, d), gold.dim_product(products, TODAY), _dim_date(s, d))]
    lines = gold.fact_sales(_items(s, d), _orders(s, d), products, staged=True)
    fact = stage(lines.select("order_item_id", "dim_customer_key", "dim_product_key", "dim_date_key", "net_revenue"), "fact")
    discard(products, *lines.staged)
    out = analytics.star(fact, *dimensions, staged=True)
    discard(fact)
    return out.select(
        "order_item_id", "customer_segment", "region", "price_tier", "margin_band", "year", "quarter", "net_revenue"
    )


@register(
    "join_scd2_point_in_time",
    query(
        """select l.order_item_id, l.product_id, cast(p.unit_price as double) as asof_unit_price, p.price_tier as asof_price_tier
        from lines l left join stg_products p on p.product_id = l.product_id and l.order_date >= p.valid_from
          and l.order_date < p.valid_to""",
        "lines",
        "stg_products",
    ),
)
def join_scd2_point_in_time(s, d):
    lines = _lines(s, d).select("order_item_id", "product_id", "order_date")
    out = scd2.join_as_of(
        lines, _products(s, d), "product_id", "order_date", ["unit_price", "price_tier"], sizes=i.items(s, d)
    )
    return out.drop("order_date")


@register(
    "versions_at_instant",
    query(
        """select customer_id, customer_segment from stg_customers where valid_from <= timestamp '1998-06-15 00:00:00'
          and timestamp '1998-06-15 00:00:00' < valid_to""",
        "stg_customers",
    ),
)
def versions_at_instant(s, d):
    return scd2.versions_at(_customers(s, d), "1998-06-15 00:00:00").select("customer_id", "customer_segment")


@register(
    "join_close_target",
    query(
        f"""select customer_id, {ts("valid_from")} as valid_from, {ts("lead_at")} as valid_to, nxt is null as is_current
        from (select customer_id, source_updated_at as valid_from, lead(source_updated_at) over w as nxt,
            coalesce(lead(source_updated_at) over w, timestamp '9999-12-31 23:59:59') as lead_at from clean_customers
          window w as (partition by customer_id order by source_updated_at))""",
        "clean_customers",
    ),
)
def join_close_target(s, d):
    rows = cleaning.clean_customers(i.customers(s, d)).select("customer_id", F.col("source_updated_at").alias("valid_from"))
    opened = rows.withColumns({"valid_to": F.lit(scd2.OPEN_END).cast("timestamp"), "is_current": F.lit(True)})
    return scd2.close_versions(opened, "customer_id")


# -- models ------------------------------------------------------------------------------------

HISTORY_SQL = f"{ts('valid_from')} as valid_from, {ts('valid_to')} as valid_to, is_current, surrogate_key, _row_hash"


@register(
    "scd2_customers",
    query(
        f"select {', '.join(CLEAN_CUSTOMER_COLUMNS)}, {CUSTOMER_TIMES_SQL}, {HISTORY_SQL} from stg_customers",
        "stg_customers",
    ),
)
def scd2_customers(s, d):
    return _customers(s, d).drop("_ingestion_timestamp")


@register("scd2_products", query(f"select {PRODUCT_SQL}, {HISTORY_SQL} from stg_products", "stg_products"))
def scd2_products(s, d):
    return _products(s, d).drop("_ingestion_timestamp")


@register(
    "scd2_hot_keys",
    query(f"select {PRODUCT_SQL}, {HISTORY_SQL} from stg_products", "stg_products"),
)
def scd2_hot_keys(s, d):
    """The same history with a low limit, so that most products take the time-sliced path."""
    return silver.stg_products(stage(i.products(s, d), "feed"), split_rows=20).drop("_ingestion_timestamp")


@register(
    "asof_hot_keys",
    query(
        """select l.order_item_id, cast(p.unit_price as double) as asof_unit_price
        from lines l left join stg_products p on p.product_id = l.product_id and l.order_date >= p.valid_from
          and l.order_date < p.valid_to""",
        "lines",
        "stg_products",
    ),
)
def asof_hot_keys(s, d):
    lines = _lines(s, d).select("order_item_id", "product_id", "order_date")
    out = scd2.join_as_of(
        lines, _products(s, d), "product_id", "order_date", ["unit_price"], split_rows=25, sizes=i.items(s, d)
    )
    return out.drop("order_date", "product_id")


@register(
    "scd2_incremental",
    query(f"select {PRODUCT_SQL}, {HISTORY_SQL} from stg_products", "stg_products"),
)
def scd2_incremental(s, d):
    """History built in two batches; the second one also brings late and repeated rows."""
    raw = stage(i.products(s, d), "feed")
    cut = F.lit("1999-01-01").cast("timestamp")
    overlap = F.lit("1998-01-01").cast("timestamp")
    history = stage(silver.stg_products(raw.filter(F.col("updated_at") < cut)), "history")
    out = silver.stg_products(raw.filter(F.col("updated_at") >= overlap), history, staged=True)
    discard(raw, history)
    return out.drop("_ingestion_timestamp")


@register(
    "scd2_change_hash",
    query(
        f"select customer_id, {ts('source_updated_at')} as source_updated_at, {key(*CUSTOMER_HASH)} as row_hash from clean_customers",
        "clean_customers",
    ),
)
def scd2_change_hash(s, d):
    clean = cleaning.clean_customers(i.customers(s, d))
    return clean.select("customer_id", "source_updated_at", scd2.change_hash(scd2.CUSTOMER_TRACKED).alias("row_hash"))


def _run() -> bronze.Run:
    return bronze.Run("run-1", F.lit(TODAY).cast("timestamp"))


def _audited_sql(sql: str, model: str) -> str:
    return f"select *, '{TODAY} 00:00:00' as _loaded_at, 'run-1' as _run_id, '{model}' as _model from ({sql})"


@register(
    "stg_orders",
    query(
        f"""select order_id, customer_id, {ts("order_date")} as order_date, order_status, payment_method, shipping_address,
          {dbl("subtotal", "discount_amount", "shipping_cost", "total_amount")}, discount_percentage, validation_status,
          cast(order_date_key as varchar) as order_date_key, order_year, order_month, order_day, order_day_of_week,
          {ts("source_created_at")} as source_created_at, {ts("source_updated_at")} as source_updated_at,
          '{TODAY} 00:00:00' as _loaded_at, 'run-1' as _run_id, 'silver.stg_orders' as _model from stg_orders""",
        "stg_orders",
    ),
)
def stg_orders(s, d):
    return silver.stg_orders(i.orders(s, d), run=_run()).drop("_ingestion_timestamp")


DIM_CUSTOMER_SQL = f"""select * replace (cast(registration_date as varchar) as registration_date,
  {ts("source_created_at")} as source_created_at, {ts("source_updated_at")} as source_updated_at) from dim_customer"""


@register("dim_customer", query(_audited_sql(DIM_CUSTOMER_SQL, "gold.dim_customer"), "dim_customer"))
def dim_customer(s, d):
    return gold.dim_customer(_customers(s, d), TODAY, _run())


DIM_PRODUCT_SQL = f"""select * replace (cast(unit_price as double) as unit_price, cast(unit_cost as double) as unit_cost,
  cast(unit_margin as double) as unit_margin, cast(inventory_value as double) as inventory_value,
  cast(inventory_retail_value as double) as inventory_retail_value,
  {ts("source_created_at")} as source_created_at, {ts("source_updated_at")} as source_updated_at) from dim_product"""


@register("dim_product", query(_audited_sql(DIM_PRODUCT_SQL, "gold.dim_product"), "dim_product"))
def dim_product(s, d):
    return gold.dim_product(_products(s, d), TODAY, _run())


@register("dim_date", query(DATE_SQL, "dim_date"))
def dim_date(s, d):
    return _dim_date(s, d)


FACT_SQL = f"""select * replace (cast(gross_revenue as double) as gross_revenue, cast(discount_amount as double) as discount_amount,
  cast(net_revenue as double) as net_revenue, cast(cost_of_goods_sold as double) as cost_of_goods_sold,
  cast(gross_profit as double) as gross_profit, cast(unit_selling_price as double) as unit_selling_price,
  cast(unit_cost as double) as unit_cost, cast(discount_percentage as double) as discount_percentage,
  {ts("order_date")} as order_date, cast(order_date_only as varchar) as order_date_only) from fact_sales"""


@register("fact_sales", query(_audited_sql(FACT_SQL, "gold.fact_sales"), "fact_sales"))
def fact_sales(s, d):
    return gold.fact_sales(_items(s, d), _orders(s, d), _products(s, d), run=_run(), staged=True)


@register("fact_sales_hot_keys", query(FACT_SQL, "fact_sales"))
def fact_sales_hot_keys(s, d):
    """The same fact while adaptive execution splits nearly every partition of its joins."""
    return gold.fact_sales(_items(s, d), _orders(s, d), _products(s, d), split_rows=3, sizes=i.items(s, d), staged=True)


@register(
    "fact_sales_dated_cost",
    query(
        """select l.order_item_id, cast(p.unit_cost as double) as unit_cost,
          cast(l.line_total - l.quantity * p.unit_cost as double) as gross_profit
        from lines l left join stg_products p on p.product_id = l.product_id and l.order_date >= p.valid_from
          and l.order_date < p.valid_to""",
        "lines",
        "stg_products",
    ),
)
def fact_sales_dated_cost(s, d):
    return _fact(s, d, cost="dated").select("order_item_id", "unit_cost", "gross_profit")


# -- analytics ---------------------------------------------------------------------------------

SUMS_SQL = ", ".join(f"cast(sum({c}) as double) as {c}" for c in analytics.ADDITIVE[1:])
SUMS_SQL = f"cast(sum(units_sold) as bigint) as units_sold, {SUMS_SQL}"


@register(
    "agg_revenue_by_segment",
    query(
        """select customer_segment, cast(sum(net_revenue) as double) as revenue from fact_sales f
        join dim_customer c on c.dim_customer_key = f.dim_customer_key group by 1""",
        "fact_sales",
        "dim_customer",
    ),
)
def agg_revenue_by_segment(s, d):
    return analytics.revenue_by_segment(_order_facts(s, d), _dim_customer(s, d))


@register(
    "sort_revenue_desc",
    query(
        """select customer_segment, cast(sum(net_revenue) as double) as revenue from fact_sales f
        join dim_customer c on c.dim_customer_key = f.dim_customer_key
        join dim_date d on d.date_key = f.dim_date_key and d.is_current_year group by 1 order by 2 desc""",
        "fact_sales",
        "dim_customer",
        "dim_date",
    ),
)
def sort_revenue_desc(s, d):
    return analytics.revenue_by_segment(_order_facts(s, d), _dim_customer(s, d), _dim_date(s, d))


@register(
    "agg_additive_measures",
    query(
        f"""select category_name, order_status, payment_method,
          cast(grouping(category_name) * 4 + grouping(order_status) * 2 + grouping(payment_method) as integer) as grouping_level,
          {SUMS_SQL} from fact_sales group by cube (category_name, order_status, payment_method)""",
        "fact_sales",
    ),
)
def agg_additive_measures(s, d):
    return analytics.additive_measures(_fact(s, d), ["category_name", "order_status", "payment_method"], "cube")


@register(
    "agg_additive_rollup",
    query(
        f"""select cast(year(order_date_only) as integer) as year, cast(month(order_date_only) as integer) as month,
          cast(grouping(year(order_date_only)) * 2 + grouping(month(order_date_only)) as integer) as grouping_level, {SUMS_SQL}
        from fact_sales group by rollup (year(order_date_only), month(order_date_only))""",
        "fact_sales",
    ),
)
def agg_additive_rollup(s, d):
    dated = _fact(s, d).withColumns({"year": F.year("order_date_only"), "month": F.month("order_date_only")})
    return analytics.additive_measures(dated, ["year", "month"], "rollup")


@register(
    "agg_semi_additive",
    query(
        f"""select category_name, {ratio("sum(gross_profit)", "sum(net_revenue)", 100)} as margin_pct,
          {ratio("sum(gross_revenue)", "sum(units_sold)")} as avg_selling_price,
          {ratio("sum(cost_of_goods_sold)", "sum(units_sold)")} as avg_unit_cost,
          {ratio("sum(discount_percentage * gross_revenue)", "sum(gross_revenue)")} as avg_discount_pct
        from fact_sales group by 1""",
        "fact_sales",
    ),
)
def agg_semi_additive(s, d):
    return analytics.semi_additive(_fact(s, d), ["category_name"])


@register(
    "agg_basket",
    query(
        f"""select payment_method, count(*) as orders, {ratio("sum(net)", "count(*)")} as avg_basket_value,
          {ratio("sum(units)", "count(*)")} as avg_units_per_order, {ratio("sum(lines)", "count(*)")} as avg_lines_per_order,
          {ratio("sum(discounted)", "sum(net)", 100)} as discounted_revenue_pct,
          {ratio("sum(gross) - sum(net)", "sum(gross)", 100)} as price_reduction_pct
        from (select order_id, payment_method, sum(net_revenue) as net, sum(gross_revenue) as gross, sum(units_sold) as units,
            count(*) as lines, sum(net_revenue) filter (where discount_percentage > 0) as discounted
          from fact_sales group by 1, 2) group by 1""",
        "fact_sales",
    ),
)
def agg_basket(s, d):
    return analytics.basket_of_orders(_order_facts(s, d), ["payment_method"])


@register(
    "agg_category_brand",
    query(
        f"""select category_name, brand, cast(grouping(category_name) * 2 + grouping(brand) as integer) as grouping_level,
          cast(sum(units_sold) as bigint) as units_sold, cast(sum(net_revenue) as double) as net_revenue,
          cast(sum(gross_profit) as double) as gross_profit, {ratio("sum(gross_profit)", "sum(net_revenue)", 100)} as margin_pct
        from fact_sales group by rollup (category_name, brand)""",
        "fact_sales",
    ),
)
def agg_category_brand(s, d):
    return analytics.category_brand(_fact(s, d))


@register(
    "agg_regional",
    query(
        """select region, count(distinct f.dim_customer_key) as customers, cast(sum(net_revenue) as double) as net_revenue,
          cast(sum(gross_profit) as double) as gross_profit
        from fact_sales f join dim_customer c on c.dim_customer_key = f.dim_customer_key group by 1""",
        "fact_sales",
        "dim_customer",
    ),
)
def agg_regional(s, d):
    return analytics.regional_performance(_order_facts(s, d, cost=True), _dim_customer(s, d))


@register(
    "agg_inventory",
    query(
        """select stock_status, count(*) as products, cast(sum(inventory_value) as double) as inventory_value,
          cast(sum(inventory_retail_value) as double) as inventory_retail_value from dim_product group by 1""",
        "dim_product",
    ),
)
def agg_inventory(s, d):
    return analytics.inventory_by_status(_dim_product(s, d))


@register(
    "agg_customer_ltv",
    query(
        """select c.customer_id, customer_segment, tenure_days, count(distinct order_id) as orders,
          cast(sum(net_revenue) as double) as lifetime_revenue, cast(sum(gross_profit) as double) as lifetime_profit,
          cast(min(order_date_only) as varchar) as first_order, cast(max(order_date_only) as varchar) as last_order
        from dim_customer c left join fact_sales f on f.customer_id = c.customer_id group by 1, 2, 3""",
        "dim_customer",
        "fact_sales",
    ),
)
def agg_customer_ltv(s, d):
    return analytics.customer_ltv(_order_facts(s, d, cost=True), _dim_customer(s, d))


@register(
    "agg_records_today",
    query(
        """select (select count(distinct customer_id) from stg_customers where cast(source_updated_at as date) = date '2001-01-01')
            as customers_updated, count(*) as lines_today, cast(coalesce(sum(net_revenue), 0) as double) as revenue_today
        from fact_sales where order_date_only = date '2001-01-01'""",
        "stg_customers",
        "fact_sales",
    ),
)
def agg_records_today(s, d):
    return analytics.records_today(_fact(s, d), _customers(s, d), "2001-01-01")


@register("agg_count_rows", query("select count(*) as n_rows from fact_sales", "fact_sales"))
def agg_count_rows(s, d):
    return _fact(s, d).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "agg_invalid_totals",
    query(
        """select count(*) filter (where not is_total_valid) as invalid_totals, count(*) filter (where is_total_valid is null)
          as unknown_totals, count(*) as orders from valid_orders""",
        "valid_orders",
    ),
)
def agg_invalid_totals(s, d):
    flagged = cleaning.validate_orders(cleaning.clean_orders(i.orders(s, d)))
    return flagged.agg(
        F.count_if(~F.col("is_total_valid")).alias("invalid_totals"),
        F.count_if(F.col("is_total_valid").isNull()).alias("unknown_totals"),
        F.count(F.lit(1)).alias("orders"),
    )


@register(
    "agg_orphan_count",
    query(
        f"""select count(*) as orphan_items from {STRAY_ITEMS} where order_id not in
          (select order_id from raw_orders)""",
        "raw_items",
        "raw_orders",
    ),
)
def agg_orphan_count(s, d):
    _, orphan = quality.split_orphans(_stray_items(s, d), i.orders(s, d))
    return orphan.agg(F.count(F.lit(1)).alias("orphan_items"))


@register("agg_distinct_keys", "select count(distinct l_orderkey) as order_keys, count(distinct l_partkey) as part_keys from lineitem")
def agg_distinct_keys(s, d):
    return i.table(s, d, "lineitem").agg(
        F.countDistinct("l_orderkey").alias("order_keys"), F.countDistinct("l_partkey").alias("part_keys")
    )


@register(
    "agg_max_watermark", query(f"select {ts('max(_ingestion_timestamp)')} as watermark from raw_orders", "raw_orders")
)
def agg_max_watermark(s, d):
    return bronze.high_water_mark(i.orders(s, d))


# -- windows -----------------------------------------------------------------------------------


@register(
    "win_dedup_latest",
    query(
        f"""select order_item_id, order_id, product_id, quantity, {dbl("unit_price", "discount_percent", "line_total")},
          {ts("created_at")} as created_at from items""",
        "items",
    ),
)
def win_dedup_latest(s, d):
    return _items(s, d).drop("_ingestion_timestamp")


@register(
    "win_scd2_close",
    query(f"select customer_id, {ts('valid_from')} as valid_from, {ts('valid_to')} as valid_to, is_current from stg_customers", "stg_customers"),
)
def win_scd2_close(s, d):
    return scd2.close_versions(_customers(s, d), "customer_id").select("customer_id", "valid_from", "valid_to", "is_current")


@register(
    "win_price_history",
    query(
        f"""select product_id, {ts("valid_from")} as valid_from, {dbl("unit_price", "unit_cost")}, margin_percentage,
          cast(pp as double) as previous_price, pm as previous_margin, cast(unit_price - pp as double) as price_change,
          {ratio("unit_price - pp", "pp", 100)} as price_change_pct, margin_percentage - pm as margin_change
        from (select *, lag(unit_price) over w as pp, lag(margin_percentage) over w as pm from stg_products
          window w as (partition by product_id order by valid_from))""",
        "stg_products",
    ),
)
def win_price_history(s, d):
    return analytics.price_history(_products(s, d), split_rows=None)


@register(
    "win_segment_migration",
    query(
        """select from_segment, customer_segment as to_segment, count(*) as moves from (select customer_segment,
            lag(customer_segment) over (partition by customer_id order by valid_from) as from_segment from stg_customers)
        where from_segment <> customer_segment group by 1, 2""",
        "stg_customers",
    ),
)
def win_segment_migration(s, d):
    return analytics.segment_migration(_customers(s, d), split_rows=None)


@register(
    "win_period_compare",
    query(
        f"""select cast(m as varchar) as month_start, category_name, cast(revenue as double) as revenue,
          cast(prev as double) as previous_revenue, {ratio("revenue - prev", "prev", 100)} as change_pct
        from (select *, lag(revenue) over (partition by category_name order by m) as prev from (
          select category_name, cast(date_trunc('month', order_date_only) as date) as m, sum(net_revenue) as revenue
          from fact_sales group by 1, 2))""",
        "fact_sales",
    ),
)
def win_period_compare(s, d):
    return analytics.period_compare(_fact(s, d), ["category_name"])


# -- functions ---------------------------------------------------------------------------------


@register(
    "fn_surrogate_key",
    f"select c_custkey, {key('c_custkey', 'c_name', 'c_mktsegment')} as sk, "
    f"{key('case when c_acctbal >= 0 then c_mktsegment end')} as sk_null from customer",
)
def fn_surrogate_key(s, d):
    positive = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return i.table(s, d, "customer").select(
        "c_custkey", surrogate_key("c_custkey", "c_name", "c_mktsegment").alias("sk"), surrogate_key(positive).alias("sk_null")
    )


@register(
    "fn_strings",
    """select p_partkey, upper(trim(' ' || p_name || ' ')) as upper_trim, lower(p_brand) as lower_brand,
      p_name || ' / ' || p_type as joined, p_name like '%ing' as is_ing, regexp_matches(p_name, '^[a-m]') as starts_a_m,
      regexp_replace(p_brand, '[^0-9+]', '', 'g') as digits from part""",
)
def fn_strings(s, d):
    return i.table(s, d, "part").select(
        "p_partkey",
        F.upper(F.trim(F.concat(F.lit(" "), "p_name", F.lit(" ")))).alias("upper_trim"),
        F.lower("p_brand").alias("lower_brand"),
        F.concat("p_name", F.lit(" / "), "p_type").alias("joined"),
        F.col("p_name").like("%ing").alias("is_ing"),
        F.col("p_name").rlike("^[a-m]").alias("starts_a_m"),
        F.regexp_replace("p_brand", "[^0-9+]", "").alias("digits"),
    )


@register(
    "fn_dates",
    """select o_orderkey, cast(quarter(o_orderdate) as integer) as q, cast(weekofyear(o_orderdate) as integer) as w,
      cast(dayofweek(o_orderdate) as integer) + 1 as dow, cast(dayofyear(o_orderdate) as integer) as doy,
      cast(date_trunc('week', o_orderdate) as varchar)[1:10] as wk, cast(last_day(o_orderdate) as varchar)[1:10] as month_end,
      cast(cast(o_orderdate as date) + 6 as varchar)[1:10] as plus_six, cast(date '2001-12-31' - cast(o_orderdate as date) as integer) as age
    from orders""",
)
def fn_dates(s, d):
    c = F.col("o_orderdate")
    return i.table(s, d, "orders").select(
        "o_orderkey",
        F.quarter(c).alias("q"),
        F.weekofyear(c).alias("w"),
        F.dayofweek(c).alias("dow"),
        F.dayofyear(c).alias("doy"),
        F.date_trunc("week", c).cast("date").alias("wk"),
        F.last_day(c).alias("month_end"),
        F.date_add(c.cast("date"), 6).alias("plus_six"),
        F.datediff(F.lit(TODAY).cast("date"), c.cast("date")).alias("age"),
    )


@register(
    "fn_numbers",
    """select l_orderkey, l_linenumber, l_partkey, abs(l_discount - 0.05) as gap, cast(floor(l_quantity / 7) as bigint) as sevens,
      cast(l_extendedprice as decimal(12,2))::double as price, l_extendedprice / nullif(l_discount, 0) as per_discount,
      cast(round(cast(l_extendedprice as decimal(12,2)) * cast(0.97 as decimal(3,2)), 2) as double) as reduced,
      try_cast(l_returnflag as integer) as not_a_number from lineitem""",
)
def fn_numbers(s, d):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return i.table(s, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.abs(F.col("l_discount") - 0.05).alias("gap"),
        F.floor(F.col("l_quantity") / 7).alias("sevens"),
        price.alias("price"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_discount"), F.lit(0.0))).alias("per_discount"),
        F.round(price * F.lit("0.97").cast("decimal(3,2)"), 2).alias("reduced"),
        F.col("l_returnflag").try_cast("int").alias("not_a_number"),
    )


@register("set_distinct", "select distinct l_orderkey from lineitem")
def set_distinct(s, d):
    return i.table(s, d, "lineitem").select("l_orderkey").distinct()


# -- data quality ------------------------------------------------------------------------------

ORDER_RULES = [r for r in ORDERS.all_rules() if quality.is_row_level(r)]


@register(
    "dq_not_null",
    query(
        """select count(*) as n_rows, count(*) filter (where total_amount is null) as total_nulls,
          count(*) filter (where order_id is null) as id_nulls from clean_orders""",
        "clean_orders",
    ),
)
def dq_not_null(s, d):
    df = cleaning.clean_orders(i.orders(s, d))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("total_amount").isNull()).alias("total_nulls"),
        F.count_if(F.col("order_id").isNull()).alias("id_nulls"),
    )


@register("dq_unique", query("select order_item_id, count(*) as n_rows from raw_items group by 1 having count(*) > 1", "raw_items"))
def dq_unique(s, d):
    return dedup.duplicate_keys(i.items(s, d), ["order_item_id"])


def _accepted(column, values):
    from granary.sources.contracts import Rule

    return quality.violation(Rule("allowed", "accepted_values", (column,), values=tuple(values)))


@register(
    "dq_accepted_values",
    query(
        """select order_status, count(*) as violations from clean_orders where order_status not in
          ('PENDING','CONFIRMED','SHIPPED','DELIVERED','CANCELLED','RETURNED') group by 1""",
        "clean_orders",
    ),
)
def dq_accepted_values(s, d):
    from granary.sources.contracts import ORDER_STATUSES

    bad = cleaning.clean_orders(i.orders(s, d)).filter(_accepted("order_status", ORDER_STATUSES))
    return bad.groupBy("order_status").agg(F.count(F.lit(1)).alias("violations"))


@register(
    "dq_relationships",
    query(
        f"""select 'order_items' as table_name, 'order_exists' as rule, 'referential_integrity' as kind, 'critical' as severity,
          count(*) as rows_checked, count(*) filter (where order_id not in (select order_id from raw_orders)) as violations, 'FAIL' as status from {STRAY_ITEMS}""",
        "raw_items",
        "raw_orders",
    ),
)
def dq_relationships(s, d):
    from granary.sources.contracts import Rule

    rule = Rule("order_exists", "referential_integrity", ("order_id",), target_table="orders", target_column="order_id")
    return quality.relationship(_stray_items(s, d), i.orders(s, d), "order_items", rule)


@register(
    "dq_expression",
    query(
        """select count(*) filter (where not (unit_cost <= unit_price)) as cost_above_price,
          count(*) filter (where not (unit_price > 0)) as price_not_positive,
          count(*) filter (where not (margin_percentage is null or margin_percentage <= 100)) as margin_too_high
        from clean_products""",
        "clean_products",
    ),
)
def dq_expression(s, d):
    from granary.sources.contracts import Rule

    def bad(e):
        return F.count_if(quality.violation(Rule("r", "comparison", expression=e)))

    df = cleaning.enrich_products(cleaning.clean_products(i.products(s, d)))
    return df.agg(
        bad("unit_cost <= unit_price").alias("cost_above_price"),
        bad("unit_price > 0").alias("price_not_positive"),
        bad("margin_percentage IS NULL OR margin_percentage <= 100").alias("margin_too_high"),
    )


@register(
    "dq_regex",
    query(
        r"""select count(*) as n_rows, count(*) filter (where not regexp_matches(email,
            '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')) as raw_violations,
          count(*) filter (where not regexp_matches(lower(trim(email)),
            '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')) as clean_violations from raw_customers""",
        "raw_customers",
    ),
)
def dq_regex(s, d):
    rule = [r for r in CUSTOMERS.rules if r.kind == "regex"][0]
    both = i.customers(s, d).select("email", F.lower(F.trim("email")).alias("clean"))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(quality.violation(rule)).alias("raw_violations"),
        F.count_if(F.coalesce(~F.col("clean").rlike(rule.pattern), F.lit(False))).alias("clean_violations"),
    )


@register(
    "dq_nullability_type",
    query(
        """with f as (select count(*) as n, count(*) filter (where is_active is null) as ia,
            count(*) filter (where country_code is null) as cc,
            count(*) filter (where registration_date < date '1995-02-01') as rd from raw_customers)
        select 'customers' as table_name, n as rows_checked, column_name, data_type,
          case column_name when 'is_active' then ia when 'country_code' then cc else 0 end as null_violations,
          case column_name when 'registration_date' then rd else 0 end as type_violations
        from f, (values ('customer_id','string'), ('first_name','string'), ('last_name','string'), ('email','string'),
          ('phone','string'), ('address_line1','string'), ('city','string'), ('state','string'), ('postal_code','string'),
          ('country_code','string'), ('customer_segment','string'), ('registration_date','date'), ('is_active','boolean'),
          ('created_at','timestamp'), ('updated_at','timestamp')) t(column_name, data_type)""",
        "raw_customers",
    ),
)
def dq_nullability_type(s, d):
    raw = i.customers(s, d)
    early = F.col("registration_date") < "1995-02-01"
    text = F.when(early, F.lit("not a date")).otherwise(F.col("registration_date").cast("string"))
    return quality.nullability_and_type(raw.withColumn("registration_date", text), CUSTOMERS)


@register(
    "dq_freshness",
    query(
        f"""select 'orders' as table_name, {ts("newest")} as newest, age_hours,
          case when age_hours > 6 then 'ERROR' when age_hours > 2 then 'WARN' else 'PASS' end as status
        from (select max(_ingestion_timestamp) as newest,
          cast(epoch_us(timestamp '2001-09-01 06:00:00') - epoch_us(max(_ingestion_timestamp)) as double) / 3.6e9 as age_hours
          from raw_orders)""",
        "raw_orders",
    ),
)
def dq_freshness(s, d):
    return quality.freshness(i.orders(s, d), "orders", "2001-09-01 06:00:00", 2, 6, "_ingestion_timestamp")


@register(
    "dq_severity_gate",
    query(
        """select order_id, order_status, 'quarantined' as outcome, concat_ws(',',
            case when total_amount is null then 'total_amount_not_null' end,
            case when order_status not in ('PENDING','CONFIRMED','SHIPPED','DELIVERED','CANCELLED','RETURNED') then 'order_status_allowed' end,
            case when payment_method not in ('CREDIT_CARD','DEBIT_CARD','PIX','BOLETO','WALLET') then 'payment_method_allowed' end,
            case when not (abs(total_amount - (subtotal - discount_amount + shipping_cost)) < 0.01) then 'total_calculation' end) as reasons
        from clean_orders where reasons <> ''
        union all
        select order_id, order_status, 'valid', '' from clean_orders where total_amount is not null
          and order_status in ('PENDING','CONFIRMED','SHIPPED','DELIVERED','CANCELLED','RETURNED')
          and payment_method in ('CREDIT_CARD','DEBIT_CARD','PIX','BOLETO','WALLET')
          and abs(total_amount - (subtotal - discount_amount + shipping_cost)) < 0.01""",
        "clean_orders",
    ),
)
def dq_severity_gate(s, d):
    df = cleaning.clean_orders(i.orders(s, d)).withColumnsRenamed(
        {"source_created_at": "created_at", "source_updated_at": "updated_at"}
    )
    valid, bad = quality.severity_gate(df, ORDER_RULES)
    reasons = F.array_join("_quarantine_reasons", ",")
    return bad.select("order_id", "order_status", F.lit("quarantined").alias("outcome"), reasons.alias("reasons")).unionByName(
        valid.select("order_id", "order_status", F.lit("valid").alias("outcome"), F.lit("").alias("reasons"))
    )


@register(
    "dq_order_total",
    query(
        """select order_id, cast(total_amount as double) as total_amount, cast(calculated_total as double) as calculated_total
        from clean_orders where not (abs(total_amount - (subtotal - discount_amount + shipping_cost)) < 0.01)""",
        "clean_orders",
    ),
)
def dq_order_total(s, d):
    rule = [r for r in ORDERS.rules if r.name == "total_calculation"][0]
    bad = cleaning.clean_orders(i.orders(s, d)).filter(quality.violation(rule))
    return bad.select("order_id", "total_amount", "calculated_total")


@register(
    "dq_line_total",
    query(
        """select discount_percent::double as discount_percent, count(*) as violations from raw_items
        where not (abs(line_total - quantity * unit_price * (1 - cast(discount_percent * cast(0.01 as decimal(3,2)) as decimal(9,4)))) < 0.01)
        group by 1""",
        "raw_items",
    ),
)
def dq_line_total(s, d):
    from granary.sources.contracts import ORDER_ITEMS

    rule = [r for r in ORDER_ITEMS.rules if r.name == "line_total_calculation"][0]
    bad = i.items(s, d).filter(quality.violation(rule))
    return bad.groupBy("discount_percent").agg(F.count(F.lit(1)).alias("violations"))


@register(
    "dq_orphan_quarantine",
    query(
        f"""select case when order_id in (select order_id from raw_orders) then 'valid'
            else 'quarantined' end as outcome, count(*) as items, cast(sum(line_total) as double) as line_total
        from {STRAY_ITEMS} group by 1""",
        "raw_items",
        "raw_orders",
    ),
)
def dq_orphan_quarantine(s, d):
    valid, bad = quality.split_orphans(_stray_items(s, d), i.orders(s, d))
    both = valid.withColumn("outcome", F.lit("valid")).unionByName(bad.withColumn("outcome", F.lit("quarantined")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("items"), F.sum("line_total").alias("line_total"))


def _order_results(s, d):
    df = cleaning.clean_orders(i.orders(s, d)).withColumnsRenamed(
        {"source_created_at": "created_at", "source_updated_at": "updated_at"}
    )
    customers = i.table(s, d, "customer").select(i.customer_id("c_custkey").alias("customer_id"))
    return quality.run_rules(df, "orders", ORDERS.all_rules(), {"customers": customers})


ORDER_RESULTS_SQL = """(select count(*) as n, count(*) filter (where total_amount is null) as tn,
    count(*) filter (where order_status not in ('PENDING','CONFIRMED','SHIPPED','DELIVERED','CANCELLED','RETURNED')) as st,
    count(*) filter (where payment_method not in ('CREDIT_CARD','DEBIT_CARD','PIX','BOLETO','WALLET')) as pm,
    count(*) filter (where not (abs(total_amount - calculated_total) < 0.01)) as tc,
    (select count(*) from (select order_id from clean_orders group by 1 having count(*) > 1)) as du from clean_orders)"""
ORDER_RESULTS = f"""select 'orders' as table_name, rule, kind, 'critical' as severity, n as rows_checked, v as violations,
    case when v = 0 then 'PASS' else 'FAIL' end as status
  from (select n, unnest([
      struct_pack(rule := 'order_id_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'customer_id_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'order_date_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'order_status_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'payment_method_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'subtotal_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'discount_amount_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'shipping_cost_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'total_amount_not_null', kind := 'not_null', v := tn),
      struct_pack(rule := 'created_at_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'updated_at_not_null', kind := 'not_null', v := 0),
      struct_pack(rule := 'order_status_allowed', kind := 'accepted_values', v := st),
      struct_pack(rule := 'payment_method_allowed', kind := 'accepted_values', v := pm),
      struct_pack(rule := 'total_calculation', kind := 'comparison', v := tc),
      struct_pack(rule := 'order_id_unique', kind := 'uniqueness', v := du),
      struct_pack(rule := 'customer_exists', kind := 'referential_integrity', v := 0)], recursive := true)
    from {ORDER_RESULTS_SQL})"""


@register("dq_rule_results", query(ORDER_RESULTS, "clean_orders"))
def dq_rule_results(s, d):
    return _order_results(s, d)


@register(
    "dq_test_run",
    query(
        f"""select table_name, count(*) as tests_run, count(*) filter (where status = 'PASS') as tests_passed,
          count(*) filter (where status <> 'PASS') as tests_failed, count(*) filter (where status = 'FAIL') as critical_failed,
          case when count(*) filter (where status <> 'PASS') = 0 then 'PASSED' else 'FAILED' end as status
        from ({ORDER_RESULTS}) r group by 1""",
        "clean_orders",
    ),
)
def dq_test_run(s, d):
    return quality.run_summary(_order_results(s, d))


QUALITY_TABLES = {
    "orders": (["order_id", "customer_id", "total_amount"], ["order_id"]),
    "order_items": (["order_item_id", "order_id", "product_id"], ["order_item_id"]),
    "customers": (["customer_id", "email", "country_code"], ["customer_id", "updated_at"]),
}


def _table_quality(s, d):
    frames = {"orders": i.orders(s, d), "order_items": i.items(s, d), "customers": i.customers(s, d)}
    parts = []
    for name, (required, keys) in QUALITY_TABLES.items():
        typed = {required[0]: "int"} if name == "customers" else None
        parts.append(quality.table_quality(frames[name], name, required, keys, typed))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _quality_sql(name, raw, columns, typed):
    required, keys = QUALITY_TABLES[name]
    nulls = " + ".join(f"count(*) filter (where {c} is null)" for c in required)
    types = f"count(*) filter (where {required[0]} is not null and try_cast({required[0]} as integer) is null)" if typed else "0"
    cells = len(required) + (1 if typed else 0) + 1
    return f"""select table_name, row_count, column_count, null_violations, unique_violations, type_violations,
        {ratio(f"row_count * {cells} - (null_violations + type_violations + unique_violations)", f"row_count * {cells}", 100)}
          as quality_score
      from (select '{name}' as table_name, count(*) as row_count, {columns} as column_count, {nulls} as null_violations,
          coalesce((select cast(sum(n - 1) as bigint) from (select count(*) as n from {raw} group by {", ".join(keys)})), 0)
            as unique_violations,
          {types} as type_violations from {raw})"""


TABLE_QUALITY_SQL = " union all ".join(
    [
        _quality_sql("orders", "raw_orders", 13, False),
        _quality_sql("order_items", "raw_items", 9, False),
        _quality_sql("customers", "raw_customers", 16, True),
    ]
)


@register("agg_table_quality", query(TABLE_QUALITY_SQL, "raw_orders", "raw_items", "raw_customers"))
def agg_table_quality(s, d):
    return _table_quality(s, d)


@register(
    "agg_overall_quality",
    query(
        f"""select count(*) as tables, cast(sum(row_count) as bigint) as rows,
          {ratio("sum(cast(round(quality_score, 6) as decimal(12,6)) * row_count)", "sum(row_count)")} as overall_score
        from ({TABLE_QUALITY_SQL}) t""",
        "raw_orders",
        "raw_items",
        "raw_customers",
    ),
)
def agg_overall_quality(s, d):
    return quality.overall_quality(_table_quality(s, d))


def _scorecards(s, d):
    from granary.sources.contracts import ORDER_ITEMS, PRODUCTS

    items_rules = [r for r in ORDER_ITEMS.rules if r.kind == "comparison"]
    product_rules = [r for r in PRODUCTS.rules if r.kind == "comparison"]
    order_rules = [r for r in ORDERS.all_rules() if r.kind in ("accepted_values", "comparison")]
    month = 24 * 31
    staged = silver.stg_orders(i.orders(s, d))
    return (
        quality.scorecard(
            i.items(s, d), "order_items", "bronze", ["order_id", "product_id"], ["order_item_id"], items_rules,
            "_ingestion_timestamp", "2001-08-01 00:00:00", month,
        )
        .unionByName(
            quality.scorecard(
                staged, "stg_orders", "silver", ["order_id", "total_amount"], ["order_id"], order_rules,
                "_ingestion_timestamp", "2001-08-01 00:00:00", month,
            )
        )
        .unionByName(
            quality.scorecard(
                cleaning.enrich_products(cleaning.clean_products(i.products(s, d))), "stg_products", "silver",
                ["product_id", "subcategory_name"], ["product_id", "source_updated_at"], product_rules,
                "_ingestion_timestamp", "2001-08-01 00:00:00", month,
            )
        )
    )


def _score_sql(table, layer, raw, required, keys, rules):
    filled = " + ".join(f"count({c})" for c in required)
    bad = [f"count(*) filter (where not ({r}))" for r in rules]
    passed = " + ".join(f"cast({b} = 0 as integer)" for b in bad)
    n = len(rules)
    return f"""select '{table}' as table_name, '{layer}' as layer, {ratio("filled", f"n * {len(required)}", 100)} as completeness,
        {ratio("k", "n", 100)} as uniqueness, {ratio(f"n * {n} - bad", f"n * {n}", 100)} as validity,
        {ratio("fresh", "n", 100)} as freshness, cast(passed + cast(k = n as integer) as bigint) as tests_passed,
        cast({n} - passed + cast(k <> n as integer) as bigint) as tests_failed
      from (select count(*) as n, {filled} as filled, {" + ".join(bad)} as bad, {passed} as passed,
          count(*) filter (where _ingestion_timestamp >= timestamp '2001-08-01 00:00:00' - interval 744 hours) as fresh,
          (select count(*) from (select 1 from {raw} group by {", ".join(keys)})) as k from {raw})"""


SCORES_SQL = f"""select *, (completeness + uniqueness + validity + freshness) / 4 as overall,
    case when (completeness + uniqueness + validity + freshness) / 4 >= 98 then 'GREEN'
      when (completeness + uniqueness + validity + freshness) / 4 >= 95 then 'YELLOW' else 'RED' end as band
  from ({" union all ".join([
    _score_sql("order_items", "bronze", "raw_items", ["order_id", "product_id"], ["order_item_id"], [
        "quantity > 0",
        "abs(line_total - quantity * unit_price * (1 - cast(discount_percent * cast(0.01 as decimal(3,2)) as decimal(9,4)))) < 0.01"]),
    _score_sql("stg_orders", "silver", "stg_orders", ["order_id", "total_amount"], ["order_id"], [
        "order_status in ('PENDING','CONFIRMED','SHIPPED','DELIVERED','CANCELLED','RETURNED')",
        "payment_method in ('CREDIT_CARD','DEBIT_CARD','PIX','BOLETO','WALLET')",
        "abs(total_amount - (subtotal - discount_amount + shipping_cost)) < 0.01"]),
    _score_sql("stg_products", "silver", "clean_products", ["product_id", "subcategory_name"],
        ["product_id", "source_updated_at"], ["unit_price > 0", "unit_cost <= unit_price"])])}) t"""  # fmt: skip


@register("dq_scorecard", query(SCORES_SQL, "raw_items", "stg_orders", "clean_products"))
def dq_scorecard(s, d):
    return _scorecards(s, d)


@register(
    "agg_layer_quality",
    query(
        f"""select layer, round(cast(sum(cast(round(overall, 6) as decimal(12,6))) as double) / count(*), 1) as overall,
          cast(sum(tests_passed) as bigint) as tests_passed, cast(sum(tests_failed) as bigint) as tests_failed
        from ({SCORES_SQL}) x group by 1""",
        "raw_items",
        "stg_orders",
        "clean_products",
    ),
)
def agg_layer_quality(s, d):
    return quality.layer_quality(_scorecards(s, d))


QUALITY_TREND_SQL = query(
        f"""select cast(day as varchar) as day, {ratio("sum(p) filter (where layer = 'bronze')", "sum(c) filter (where layer = 'bronze')", 100)}
            as bronze, {ratio("sum(p) filter (where layer = 'silver')", "sum(c) filter (where layer = 'silver')", 100)} as silver
        from (select 'bronze' as layer, cast(_ingestion_timestamp as date) as day, 1 as c,
              coalesce(cast(is_total_valid as integer), 0) as p from valid_orders
            union all select 'silver', cast(_ingestion_timestamp as date), 1, cast(validation_status = 'VALID' as integer)
              from stg_orders) group by 1""",
        "valid_orders",
        "stg_orders",
)


@register("agg_quality_trend", QUALITY_TREND_SQL)
def agg_quality_trend(s, d):
    flagged = cleaning.validate_orders(cleaning.clean_orders(i.orders(s, d)))
    day = F.to_date("_ingestion_timestamp").alias("day")

    def daily(df, layer, ok):
        rows = df.select(F.lit(layer).alias("layer"), day, F.coalesce(ok.cast("int"), F.lit(0)).alias("ok"))
        return rows.groupBy("layer", "day").agg(F.sum("ok").alias("passed"), F.count(F.lit(1)).alias("checks"))

    both = daily(flagged, "bronze", F.col("is_total_valid")).unionByName(
        daily(_orders(s, d), "silver", F.col("validation_status") == "VALID")
    )
    return quality.quality_trend(both, ["bronze", "silver"])
