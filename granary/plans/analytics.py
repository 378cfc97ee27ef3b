"""Questions asked of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.numbers import ratio
from granary.operators.skew import SPLIT_ROWS, join_unique, with_neighbours
from granary.session import stage

ADDITIVE = [
    "units_sold", "gross_revenue", "net_revenue", "discount_amount", "cost_of_goods_sold", "gross_profit",
]


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ADDITIVE]


def star(
    fact: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    date: DataFrame,
    staged: bool = False,
) -> DataFrame:
    """Fact with its dimensions. ``staged`` writes what the last join reads, so that the fact is not read after the call."""
    c = customer.select("dim_customer_key", "customer_segment", "region", "state", "tenure_segment")
    p = product.select("dim_product_key", "price_tier", "margin_band", "category_path")
    d = date.select(F.col("date_key").alias("dim_date_key"), "year", "quarter", "month", "is_current_year")
    out = join_unique(fact.join(d, "dim_date_key"), c, ["dim_customer_key"])
    return join_unique(stage(out, "star") if staged else out, p, ["dim_product_key"])


def revenue_by_segment(fact: DataFrame, customer: DataFrame, date: DataFrame | None = None) -> DataFrame:
    """Net revenue per customer segment, largest first; with ``date`` only the current year."""
    if date is not None:
        this_year = date.filter("is_current_year").select(F.col("date_key").alias("dim_date_key"))
        fact = fact.join(this_year, "dim_date_key", "left_semi")
    # revenue is summed per customer first, so the join and the hot customer both shrink
    per_customer = fact.groupBy("dim_customer_key").agg(F.sum("net_revenue").alias("revenue"))
    joined = per_customer.join(customer.select("dim_customer_key", "customer_segment"), "dim_customer_key")
    return joined.groupBy("customer_segment").agg(F.sum("revenue").alias("revenue")).orderBy(F.desc("revenue"))


def additive_measures(df: DataFrame, dimensions: list[str], sets: str = "plain") -> DataFrame:
    """Sums over a dimension list: plain groups, ``rollup`` or ``cube`` (any combination)."""
    if sets == "plain":
        return df.groupBy(*dimensions).agg(*_sums())
    grouped = df.rollup(*dimensions) if sets == "rollup" else df.cube(*dimensions)
    return grouped.agg(F.grouping_id().cast("int").alias("grouping_level"), *_sums())


def semi_additive(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Weighted prices and rates, from exact sums."""
    units = F.sum("units_sold")
    weighted_rate = F.sum(F.col("discount_percentage") * F.col("gross_revenue"))
    return df.groupBy(*dimensions).agg(
        ratio(F.sum("gross_profit"), F.sum("net_revenue"), 100).alias("margin_pct"),
        ratio(F.sum("gross_revenue"), units).alias("avg_selling_price"),
        ratio(F.sum("cost_of_goods_sold"), units).alias("avg_unit_cost"),
        ratio(weighted_rate, F.sum("gross_revenue")).alias("avg_discount_pct"),
    )


def basket(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Basket value, items per order and how much of the gross value the discounts took, from the fact's lines."""
    per_order = df.groupBy("order_id", *dimensions).agg(
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("units_sold").alias("units_sold"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(F.col("discount_percentage") > 0, F.col("net_revenue"))).alias("discounted_revenue"),
    )
    return basket_of_orders(per_order, dimensions)


def basket_of_orders(order_facts: DataFrame, dimensions: list[str]) -> DataFrame:
    """The same from one row per order."""
    named = {"net_revenue": "net", "gross_revenue": "gross", "units_sold": "units", "discounted_revenue": "discounted_net"}
    per_order = order_facts.select(*dimensions, "lines", *[F.col(a).alias(b) for a, b in named.items()])
    orders = F.count(F.lit(1))
    return per_order.groupBy(*dimensions).agg(
        orders.alias("orders"),
        ratio(F.sum("net"), orders).alias("avg_basket_value"),
        ratio(F.sum("units"), orders).alias("avg_units_per_order"),
        ratio(F.sum("lines"), orders).alias("avg_lines_per_order"),
        ratio(F.sum("discounted_net"), F.sum("net"), 100).alias("discounted_revenue_pct"),
        ratio(F.sum("gross") - F.sum("net"), F.sum("gross"), 100).alias("price_reduction_pct"),
    )


def category_brand(fact: DataFrame) -> DataFrame:
    """Drill-down category > brand with subtotals."""
    out = fact.rollup("category_name", "brand").agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_profit").alias("gross_profit"),
    )
    return out.withColumn("margin_pct", ratio("gross_profit", "net_revenue", 100))


def regional_performance(fact: DataFrame, customer: DataFrame) -> DataFrame:
    per_customer = fact.groupBy("dim_customer_key").agg(
        F.sum("net_revenue").alias("net_revenue"), F.sum("gross_profit").alias("gross_profit")
    )
    joined = per_customer.join(customer.select("dim_customer_key", "region"), "dim_customer_key")
    return joined.groupBy("region").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_profit").alias("gross_profit"),
    )


def inventory_by_status(product: DataFrame) -> DataFrame:
    return product.groupBy("stock_status").agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("inventory_value").alias("inventory_value"),
        F.sum("inventory_retail_value").alias("inventory_retail_value"),
    )


def customer_ltv(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Lifetime revenue, orders and tenure of every customer, also those without orders."""
    # one row per order first: the order count then needs no distinct aggregate per customer
    per_order = fact.groupBy("customer_id", "order_id").agg(
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        F.min("order_date_only").alias("day"),
    )
    per_customer = per_order.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("net_revenue").alias("lifetime_revenue"),
        F.sum("gross_profit").alias("lifetime_profit"),
        F.min("day").alias("first_order"),
        F.max("day").alias("last_order"),
    )
    out = customer.select("customer_id", "customer_segment", "tenure_days").join(per_customer, "customer_id", "left")
    return out.withColumn("orders", F.coalesce("orders", F.lit(0).cast("long")))


def records_today(fact: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """Customers updated, orders and revenue of one day, as a single row."""
    day = F.lit(as_of).cast("date")
    updated = customers.filter(F.to_date("source_updated_at") == day)
    sales = fact.filter(F.col("order_date_only") == day)
    n_updated = updated.agg(F.countDistinct("customer_id")).scalar()
    out = sales.agg(
        F.count(F.lit(1)).alias("lines_today"),
        F.coalesce(F.sum("net_revenue"), F.lit(0).cast("decimal(22,2)")).alias("revenue_today"),
    )
    return out.withColumn("customers_updated", n_updated)


def period_compare(fact: DataFrame, dimensions: list[str] | None = None) -> DataFrame:
    """Monthly net revenue with the month before and the change in percent.

    The window runs over monthly sums: its groups have one row per month.
    """
    dims = dimensions or []
    month = F.trunc("order_date_only", "month").alias("month_start")
    monthly = fact.groupBy(*dims, month).agg(F.sum("net_revenue").alias("revenue"))
    w = Window.partitionBy(*dims).orderBy("month_start")
    out = monthly.withColumn("previous_revenue", F.lag("revenue").over(w))
    return out.withColumn("change_pct", ratio(F.col("revenue") - F.col("previous_revenue"), "previous_revenue", 100))


def price_history(products: DataFrame, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Price and margin change of every product version against the one before."""
    base = products.select("product_id", "valid_from", "unit_price", "unit_cost", "margin_percentage")
    out = with_neighbours(
        base,
        ["product_id"],
        ["valid_from"],
        previous={"previous_price": "unit_price", "previous_margin": "margin_percentage"},
        split_rows=split_rows,
    )
    return out.drop("_has_previous").withColumns(
        {
            "price_change": F.col("unit_price") - F.col("previous_price"),
            "price_change_pct": ratio(F.col("unit_price") - F.col("previous_price"), "previous_price", 100),
            "margin_change": F.col("margin_percentage") - F.col("previous_margin"),
        }
    )


def segment_migration(customers: DataFrame, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """How often customers moved from one segment to another."""
    base = customers.select("customer_id", "valid_from", "customer_segment")
    out = with_neighbours(
        base, ["customer_id"], ["valid_from"], previous={"from_segment": "customer_segment"}, split_rows=split_rows
    )
    moved = out.filter("_has_previous AND NOT (from_segment <=> customer_segment)")
    return moved.groupBy("from_segment", F.col("customer_segment").alias("to_segment")).agg(
        F.count(F.lit(1)).alias("moves")
    )
