"""Gold star schema: customer, product and date dimensions and the sales fact at order-line grain.

Dates relative to "today" take an ``as_of`` date, so a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.keys import date_key, surrogate_key
from granary.functions.numbers import ladder, ratio
from granary.operators.scd2 import current_only, join_as_of
from granary.operators.bronze import Run, audited
from granary.operators.skew import SPLIT_ROWS, join_unique
from granary.session import discard, stage

# Regions of the states, segment ranks and label ladders.
REGION_STATES = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
SEGMENT_RANKS = {"BRONZE": 1, "SILVER": 2, "GOLD": 3, "PLATINUM": 4}
TENURE_STEPS = [(90, "NEW"), (365, "DEVELOPING"), (730, "ESTABLISHED")]
MARGIN_STEPS = [(10, "LOW_MARGIN"), (25, "STANDARD_MARGIN"), (40, "GOOD_MARGIN")]
LIFECYCLE_STEPS = [(30, "NEW_ARRIVAL"), (180, "CURRENT"), (365, "ESTABLISHED")]
DAYS_PER_YEAR = 365.25


def region_of(state: str | Column) -> Column:
    c = F.col(state) if isinstance(state, str) else state
    out = None
    for region, states in REGION_STATES.items():
        out = F.when(c.isin(*states), region) if out is None else out.when(c.isin(*states), region)
    return out.otherwise("Unknown")


def segment_rank(segment: str) -> Column:
    out = None
    for name, rank in SEGMENT_RANKS.items():
        hit = F.col(segment) == name
        out = F.when(hit, rank) if out is None else out.when(hit, rank)
    return out.otherwise(0)


def enrich_dim_customer(df: DataFrame, as_of: str) -> DataFrame:
    days = F.datediff(F.lit(as_of).cast("date"), F.col("registration_date"))
    return df.withColumns(
        {
            "full_name": F.concat("first_name", F.lit(" "), "last_name"),
            "tenure_days": days,
            "tenure_years": F.floor(days / F.lit(DAYS_PER_YEAR)).cast("int"),
            "tenure_segment": ladder(days, TENURE_STEPS, "LOYAL"),
            "region": region_of("state"),
            "segment_rank": segment_rank("customer_segment"),
            "status_description": F.when(F.col("is_active"), "Active").otherwise("Inactive"),
        }
    )


def dim_customer(history: DataFrame, as_of: str, run: Run | None = None) -> DataFrame:
    out = enrich_dim_customer(current_only(history), as_of).select(
        surrogate_key("customer_id").alias("dim_customer_key"),
        "customer_id", "first_name", "last_name", "full_name", "email", "phone", "address_line1", "city", "state",
        "postal_code", "country_code", "region", "customer_segment", "segment_rank", "tenure_segment",
        "registration_date", "tenure_days", "tenure_years", "is_active", "status_description",
        "source_created_at", "source_updated_at",
    )
    return audited(out, "gold.dim_customer", run)


def enrich_dim_product(df: DataFrame, as_of: str) -> DataFrame:
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date("source_created_at"))
    path = F.concat("category_name", F.lit(" > "), F.coalesce("subcategory_name", F.lit("General")))
    return df.withColumns(
        {
            "category_path": path,
            "margin_band": ladder("margin_percentage", MARGIN_STEPS, "HIGH_MARGIN"),
            "inventory_value": F.col("stock_quantity") * F.col("unit_cost"),
            "inventory_retail_value": F.col("stock_quantity") * F.col("unit_price"),
            "days_in_catalog": days,
            "product_lifecycle_stage": ladder(days, LIFECYCLE_STEPS, "LEGACY"),
            "product_status": F.when(F.col("is_active"), "Active").otherwise("Discontinued"),
        }
    )


def dim_product(history: DataFrame, as_of: str, run: Run | None = None) -> DataFrame:
    out = enrich_dim_product(current_only(history), as_of).select(
        surrogate_key("product_id").alias("dim_product_key"),
        "product_id", "product_name", "brand", "category_id", "category_name", "subcategory_name", "category_path",
        "unit_price", "unit_cost", "unit_margin", "margin_percentage", "price_tier", "margin_band",
        "stock_quantity", "stock_status", "inventory_value", "inventory_retail_value",
        "days_in_catalog", "product_lifecycle_stage", "is_active", "product_status",
        "source_created_at", "source_updated_at",
    )
    return audited(out, "gold.dim_product", run)


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day between ``start`` and ``end`` (both included) of a one-row frame."""
    days = F.sequence(F.to_date("start"), F.to_date("end"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("calendar_date"))


def date_bounds(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))


def build_dim_date(
    spine: DataFrame, as_of: str, fiscal_start_month: int = 1, holidays: DataFrame | None = None
) -> DataFrame:
    """Calendar attributes. ``holidays`` is an optional ``(calendar_date, holiday_name)`` table."""
    d, today = F.col("calendar_date"), F.lit(as_of).cast("date")
    fiscal = F.add_months(d, (13 - fiscal_start_month) % 12)
    week = F.date_trunc("week", d).cast("date")
    this_year = F.year(d) == F.year(today)
    out = spine.select(
        date_key(d).alias("date_key"),
        "calendar_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "E").alias("day_name_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "yyyy-QQQ").alias("year_quarter"),
        week.alias("week_start_date"),
        F.date_add(week, 6).alias("week_end_date"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.year(fiscal).alias("fiscal_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (~F.dayofweek(d).isin(1, 7)).alias("is_weekday"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d == today).alias("is_today"),
        this_year.alias("is_current_year"),
        (this_year & (F.month(d) == F.month(today))).alias("is_current_month"),
        F.datediff(d, today).alias("days_from_today"),
    )
    if holidays is None:
        return out
    named = holidays.select("calendar_date", "holiday_name").dropDuplicates(["calendar_date"])
    return out.join(named, "calendar_date", "left").withColumn("is_holiday", F.col("holiday_name").isNotNull())


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items joined to their orders."""
    line = items.select(
        "order_item_id", "order_id", "product_id", "quantity",
        F.col("unit_price").alias("line_unit_price"),
        F.col("discount_percent").alias("line_discount_percent"),
        "line_total",
    )
    head = orders.select(
        "order_id", "customer_id", "order_date", "order_date_key", "order_status", "payment_method",
        "shipping_cost", F.col("total_amount").alias("order_total"), "validation_status",
    )
    return join_unique(line, head, ["order_id"])


def with_product(
    lines: DataFrame,
    products: DataFrame,
    cost: str = "current",
    split_rows: int | None = SPLIT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Product attributes per line; the unit cost is today's, or the one valid at the order date.

    ``split_rows`` and ``sizes`` are those of ``join_as_of``, for dated costs only.
    """
    now = current_only(products).select("product_id", "unit_cost", "category_name", "subcategory_name", "brand")
    if cost == "current":
        out = join_unique(lines, now, ["product_id"], "left")
        return out.withColumnRenamed("unit_cost", "product_unit_cost")
    dated = join_as_of(lines, products, "product_id", "order_date", ["unit_cost"], split_rows=split_rows, sizes=sizes)
    out = join_unique(dated, now.drop("unit_cost"), ["product_id"], "left")
    return out.withColumnRenamed("asof_unit_cost", "product_unit_cost")


def enrich_fact(df: DataFrame) -> DataFrame:
    gross = F.col("quantity") * F.col("line_unit_price")
    discount = gross * F.col("line_discount_percent") * F.lit("0.01").cast("decimal(3,2)")
    cost = F.col("quantity") * F.col("product_unit_cost")
    profit = F.col("line_total") - cost
    return df.withColumns(
        {
            "gross_revenue": gross.cast("decimal(16,2)"),
            "discount_amount": discount.cast("decimal(18,4)"),
            "cost_of_goods_sold": cost.cast("decimal(16,2)"),
            "gross_profit": profit.cast("decimal(16,2)"),
            "margin_percentage": F.when(F.col("line_total") > 0, ratio(profit, "line_total", 100)).otherwise(0.0),
            "order_date_only": F.to_date("order_date"),
            "order_hour": F.hour("order_date"),
        }
    )


def order_facts(items: DataFrame, orders: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """The additive measures of the sales fact, one row per order with lines; profit only where ``products`` are given.

    Lines are summed per order before they meet their orders, so they are shuffled once, as partial sums. Today's costs
    come to the lines first: written and small, the products are broadcast by their size, else both sides are dealt by product.
    """
    gross = (F.col("quantity") * F.col("unit_price")).cast("decimal(16,2)")
    sums = {
        "net_revenue": F.sum("line_total"), "gross_revenue": F.sum(gross), "units_sold": F.sum("quantity"), "lines": F.count(F.lit(1)),
        "discounted_revenue": F.sum(F.when(F.col("discount_percent") > 0, F.col("line_total"))),
    }
    if products is not None:
        items = join_unique(items, current_only(products).select("product_id", F.col("unit_cost").alias("product_unit_cost")), ["product_id"], "left")
        sums["gross_profit"] = F.sum((F.col("line_total") - F.col("quantity") * F.col("product_unit_cost")).cast("decimal(16,2)"))
    per_order = items.groupBy("order_id").agg(*[v.alias(k) for k, v in sums.items()])
    head = orders.select("order_id", "customer_id", surrogate_key("customer_id").alias("dim_customer_key"), date_key("order_date_key").alias("dim_date_key"), F.to_date("order_date").alias("order_date_only"), "order_status", "payment_method")
    return per_order.join(head, "order_id")


def _staged_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """``order_lines``, with both sides written before they meet, so the disk never holds the shuffles of two steps."""
    heads = stage(orders.select("order_id", "customer_id", "order_date", "order_date_key", "order_status", "payment_method", "shipping_cost", "total_amount", "validation_status"), "orders")
    single = stage(items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent", "line_total"), "items")
    lines = stage(order_lines(single, heads).drop("shipping_cost", "order_total"), "lines")
    discard(heads, single)
    return lines


def fact_sales(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    cost: str = "current",
    split_rows: int | None = SPLIT_ROWS,
    sizes: DataFrame | None = None,
    run: Run | None = None,
    staged: bool = False,
) -> DataFrame:
    """Sales fact at order-line grain; with dated costs hot products are counted in ``sizes``, by default the items.

    ``staged`` writes what each join reads, for large tables whose shuffles would not fit the disk side by side. What the
    last join reads is listed in the result's ``staged``, to be discarded by a caller who has written the fact.
    """
    current = staged and cost == "current"
    if current:
        products = stage(current_only(products).select("product_id", "unit_cost", "category_name", "subcategory_name", "brand", "is_current"), "products")
    lines = _staged_lines(items, orders) if staged else order_lines(items, orders)
    out = enrich_fact(with_product(lines, products, cost, split_rows, items if sizes is None else sizes))
    out = out.select(
        surrogate_key("order_item_id").alias("fact_sales_key"),
        "order_id",
        "order_item_id",
        surrogate_key("customer_id").alias("dim_customer_key"),
        surrogate_key("product_id").alias("dim_product_key"),
        date_key("order_date_key").alias("dim_date_key"),
        "order_status",
        "payment_method",
        F.col("quantity").alias("units_sold"),
        "gross_revenue",
        "discount_amount",
        F.col("line_total").alias("net_revenue"),
        "cost_of_goods_sold",
        "gross_profit",
        F.col("line_unit_price").alias("unit_selling_price"),
        F.col("product_unit_cost").alias("unit_cost"),
        F.col("line_discount_percent").alias("discount_percentage"),
        "margin_percentage",
        "order_date",
        "order_date_only",
        "order_hour",
        "product_id",
        "category_name",
        "subcategory_name",
        "brand",
        "customer_id",
        "validation_status",
    )
    out = audited(out, "gold.fact_sales", run)
    out.staged = [lines, *([products] if current else [])] if staged else []
    return out
