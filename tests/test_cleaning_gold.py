"""Cleaning, validation, dimensions and fact on small frames."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granary.operators import bronze, cleaning, dedup
from granary.plans import analytics, gold, silver
from granary.sources.contracts import CUSTOMERS, PRODUCTS

D = Decimal
AT = datetime(2024, 3, 1, 10)


def orders(spark, *rows):
    schema = (
        "order_id string, customer_id string, order_date timestamp, order_status string, payment_method string, "
        "shipping_address string, subtotal decimal(14,4), discount_amount decimal(14,4), shipping_cost decimal(14,4), "
        "total_amount decimal(14,4), created_at timestamp, updated_at timestamp, _ingestion_timestamp timestamp"
    )
    return spark.createDataFrame([(f"o{n}", "c", AT, s, p, "x", a, b, c, t, AT, AT, AT) for n, (s, p, a, b, c, t) in enumerate(rows)], schema)


def labels(spark, strict, *rows):
    out = silver.stg_orders(orders(spark, *rows), strict)
    return [(r["validation_status"], r["total_amount"]) for r in out.orderBy("order_id").collect()]


def test_first_failure_wins_and_wrong_totals_are_replaced(spark):
    ok = ("pending ", "pix", D(10), D(1), D(2), D(11))
    got = labels(
        spark,
        False,
        ok,
        ("LOST", "CASH", D(10), D(1), D(2), D("11.01")),
        ("LOST", "CASH", D(10), D(1), D(2), D(11)),
        ("SHIPPED", "CASH", D(10), D(1), D(2), D(11)),
        ("SHIPPED", "PIX", D(10), D(1), D(2), D("11.009")),
    )
    assert [g[0] for g in got] == ["VALID", "INVALID_TOTAL", "INVALID_STATUS", "INVALID_PAYMENT", "INVALID_TOTAL"]
    assert got[1][1] == D(11) and got[0][1] == D(11)


def test_null_flags_pass_unless_strict(spark):
    row = ("SHIPPED", None, D(10), D(1), D(2), None)
    assert labels(spark, False, row) == [("VALID", D("11.00"))]
    assert labels(spark, True, row) == [("INVALID_TOTAL", D("11.00"))]


def test_zero_subtotal_has_no_discount_rate(spark):
    out = silver.stg_orders(orders(spark, ("SHIPPED", "PIX", D(0), D(1), D(1), D(0))))
    assert out.first()["discount_percentage"] is None


def test_latest_row_per_order(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None), (None, 1, "n")], "k string, t int, v string"
    )
    got = {r["k"]: (r["t"], r["v"]) for r in dedup.dedup_latest(df, ["k"], ["t"]).collect()}
    assert got == {"a": (2, "z"), "b": (1, None), None: (1, "n")}
    assert [tuple(r) for r in dedup.duplicate_keys(df, ["k"]).collect()] == [("a", 3)]


def test_customers(spark):
    df = spark.createDataFrame(
        [(" joão  ", "da SILVA", " A@B.Com ", "+55 (11) 9-8", " st 1 ", "são paulo", "sp", " 1 ", None, "gold", None, AT, AT)],
        "first_name string, last_name string, email string, phone string, address_line1 string, city string, state string, "
        "postal_code string, country_code string, customer_segment string, is_active boolean, created_at timestamp, updated_at timestamp",
    )
    r = cleaning.clean_customers(df).first()
    assert (r["first_name"], r["last_name"], r["email"], r["phone"]) == ("João", "Da Silva", "a@b.com", "+551198")
    assert (r["city"], r["state"], r["country_code"], r["customer_segment"], r["is_active"]) == ("São Paulo", "SP", "BR", "GOLD", True)


@pytest.mark.parametrize(
    "price,cost,stock,want",
    [
        ("0.00", "0.00", 0, (None, "BUDGET", "OUT_OF_STOCK")),
        ("49.99", "49.99", 9, (0.0, "BUDGET", "LOW_STOCK")),
        ("50.00", "25.00", 10, (50.0, "MID_RANGE", "NORMAL_STOCK")),
        ("999.99", "0.00", 99, (100.0, "PREMIUM", "NORMAL_STOCK")),
        ("1000.00", "1500.00", 100, (-50.0, "LUXURY", "HIGH_STOCK")),
    ],
)
def test_product_labels(spark, price, cost, stock, want):
    df = spark.createDataFrame([(D(price), D(cost), stock)], "unit_price decimal(10,2), unit_cost decimal(10,2), stock_quantity int")
    r = cleaning.enrich_products(df).first()
    assert (r["margin_percentage"], r["price_tier"], r["stock_status"]) == want


def test_contract_casts_defaults_and_reports(spark):
    names = [f.name for f in CUSTOMERS.fields]
    good = {"customer_id": "c1", "first_name": "a", "last_name": "b", "registration_date": "2024-01-01", "created_at": "2024-01-01"}
    bad = {**good, "registration_date": "31/31/2024", "is_active": "maybe", "country_code": "PT"}
    df = spark.createDataFrame([[r.get(n) for n in names] for r in (good, bad)], ", ".join(f"{n} string" for n in names))
    a, b = bronze.apply_contract(df, CUSTOMERS).collect()
    assert (a["country_code"], a["is_active"], a["registration_date"]) == ("BR", True, date(2024, 1, 1))
    assert a["_cast_failures"] == [] and a["updated_at"] is None
    assert b["_cast_failures"] == ["registration_date", "is_active"] and b["country_code"] == "PT"
    assert b["registration_date"] is None and b["is_active"] is None


def test_missing_columns_fail_and_extra_ones_stay(spark):
    df = spark.createDataFrame([("s", "9.5", 1)], "product_id string, unit_price string, extra int")
    with pytest.raises(bronze.SchemaMismatch, match="product_name"):
        bronze.enforce_schema(df, PRODUCTS.schema())
    assert bronze.extra_columns(df, PRODUCTS.schema()) == ["extra"]


@pytest.mark.parametrize("state,region", [("SP", "Sudeste"), ("AC", "Norte"), ("DF", "Centro-Oeste"), ("SC", "Sul"), ("SE", "Nordeste"), ("XX", "Unknown"), (None, "Unknown")])
def test_regions(spark, state, region):
    df = spark.createDataFrame([(state,)], "state string")
    assert df.select(gold.region_of("state")).first()[0] == region


def dates(spark, *days, **more):
    df = spark.createDataFrame([(d,) for d in days], "calendar_date date")
    return {r["calendar_date"]: r for r in gold.build_dim_date(df, "2024-02-29", **more).collect()}


def test_calendar(spark):
    leap, week53 = date(2024, 2, 29), date(2021, 1, 1)
    got = dates(spark, leap, week53, date(2024, 6, 30), date(2024, 7, 1), fiscal_start_month=7)
    assert got[leap]["date_key"] == 20240229 and got[leap]["is_month_end"] and got[leap]["is_today"]
    assert got[leap]["year_quarter"] == "2024-Q1" and got[week53]["week_of_year"] == 53
    assert (got[leap]["week_start_date"], got[leap]["week_end_date"]) == (date(2024, 2, 26), date(2024, 3, 3))
    assert (got[date(2024, 6, 30)]["fiscal_year"], got[date(2024, 6, 30)]["fiscal_quarter"]) == (2024, 4)
    assert (got[date(2024, 7, 1)]["fiscal_year"], got[date(2024, 7, 1)]["fiscal_quarter"]) == (2025, 1)
    assert got[date(2024, 6, 30)]["is_weekend"] and not got[date(2024, 7, 1)]["is_weekend"]


def test_spine_includes_both_ends_and_holidays_join(spark):
    spine = gold.date_spine(gold.date_bounds(spark))
    assert spine.count() == 4018
    assert spine.agg(F.max("calendar_date")).first()[0] == date(2030, 12, 31)
    feast = spark.createDataFrame([(date(2024, 12, 25), "Natal")], "calendar_date date, holiday_name string")
    out = gold.build_dim_date(spine, "2024-01-01", holidays=feast)
    assert out.filter("is_holiday").count() == 1 and out.count() == 4018


def small_star(spark):
    head = orders(
        spark,
        ("SHIPPED", "PIX", D(100), D(0), D(0), D(100)),
        ("SHIPPED", "PIX", D(50), D(0), D(0), D(50)),
    )
    lines = spark.createDataFrame(
        [("i1", "o0", "p1", 2, D("30.00"), D("10.00"), D("54.00")), ("i2", "o0", "px", 1, D("46.00"), D("0.00"), D("46.00")),
         ("i3", "o1", "p1", 1, D("50.00"), D("0.00"), D("0.00")), ("i4", "gone", "p1", 1, D("1.00"), D("0.00"), D("1.00"))],
        "order_item_id string, order_id string, product_id string, quantity int, unit_price decimal(10,2), "
        "discount_percent decimal(5,2), line_total decimal(12,2)",
    )
    product = spark.createDataFrame(
        [("p1", D("10.00"), datetime(2024, 1, 1), datetime(2024, 4, 1), False), ("p1", D("20.00"), datetime(2024, 4, 1), datetime(9999, 1, 1), True)],
        "product_id string, unit_cost decimal(10,2), valid_from timestamp, valid_to timestamp, is_current boolean",
    ).withColumns({c: F.lit("n") for c in ("category_name", "subcategory_name", "brand")})
    return silver.stg_orders(head), lines, product


def test_fact(spark):
    head, lines, product = small_star(spark)
    got = {r["order_item_id"]: r for r in gold.fact_sales(lines, head, product).collect()}
    assert set(got) == {"i1", "i2", "i3"}
    a = got["i1"]
    assert (a["gross_revenue"], a["discount_amount"], a["cost_of_goods_sold"], a["gross_profit"]) == (D("60.00"), D("6.0000"), D("40.00"), D("14.00"))
    assert a["dim_date_key"] == 20240301 and a["order_hour"] == 10
    assert got["i2"]["unit_cost"] is None and got["i3"]["margin_percentage"] == 0.0
    dated = {r["order_item_id"]: r["cost_of_goods_sold"] for r in gold.fact_sales(lines, head, product, cost="dated").collect()}
    assert dated == {"i1": D("20.00"), "i2": None, "i3": D("10.00")}


def test_cube_conserves_revenue(spark):
    fact = gold.fact_sales(*reorder(small_star(spark)))
    out = analytics.additive_measures(fact, ["order_status", "brand"], "cube")
    per_level = {r["grouping_level"]: r["s"] for r in out.groupBy("grouping_level").agg(F.sum("net_revenue").alias("s")).collect()}
    assert set(per_level.values()) == {D("100.00")} and set(per_level) == {0, 1, 2, 3}


def reorder(star):
    head, lines, product = star
    return lines, head, product


def test_incremental_reads(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 3))], "id int, _ingestion_timestamp timestamp")
    assert [r["id"] for r in bronze.incremental(df, df.filter("id = 1")).collect()] == [2]
    assert bronze.incremental(df, df.filter("id = 9")).count() == 2
    late = spark.createDataFrame([("old", datetime(2024, 1, 5))], "order_id string, _ingestion_timestamp timestamp")
    new = spark.createDataFrame([("new", datetime(2024, 1, 4)), ("old", datetime(2024, 1, 1))], "order_id string, _ingestion_timestamp timestamp")
    mark = datetime(2024, 1, 2)
    assert sorted(r[0] for r in bronze.incremental_orders(new, late, mark, mark).collect()) == ["new", "old"]
