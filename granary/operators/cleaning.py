"""Cleaning, validation and enrichment of the retail tables (silver layer columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.numbers import ladder, ratio
from granary.functions.text import phone_digits, proper, upper_code
from granary.sources.contracts import ORDER_STATUSES, PAYMENT_METHODS

# Tolerance and label ladders.
TOTAL_TOLERANCE = "0.01"
PRICE_TIERS = [(50, "BUDGET"), (200, "MID_RANGE"), (1000, "PREMIUM")]
TOP_PRICE_TIER = "LUXURY"
STOCK_LEVELS = [(10, "LOW_STOCK"), (100, "NORMAL_STOCK")]


def clean_customers(df: DataFrame) -> DataFrame:
    out = df.withColumns(
        {
            "first_name": proper("first_name"),
            "last_name": proper("last_name"),
            "email": F.lower(F.trim("email")),
            "phone": phone_digits("phone"),
            "address_line1": F.trim("address_line1"),
            "city": proper("city"),
            "state": upper_code("state"),
            "postal_code": F.trim("postal_code"),
            "country_code": upper_code(F.coalesce("country_code", F.lit("BR"))),
            "customer_segment": upper_code("customer_segment"),
            "is_active": F.coalesce("is_active", F.lit(True)),
        }
    )
    return out.withColumnsRenamed({"created_at": "source_created_at", "updated_at": "source_updated_at"})


def clean_products(df: DataFrame) -> DataFrame:
    out = df.withColumns(
        {
            "product_name": F.trim("product_name"),
            "category_name": proper("category_name"),
            "subcategory_name": proper("subcategory_name"),
            "brand": proper("brand"),
            "unit_price": F.col("unit_price").cast("decimal(10,2)"),
            "unit_cost": F.col("unit_cost").cast("decimal(10,2)"),
            "is_active": F.coalesce("is_active", F.lit(True)),
        }
    )
    return out.withColumnsRenamed({"created_at": "source_created_at", "updated_at": "source_updated_at"})


def enrich_products(df: DataFrame) -> DataFrame:
    margin = F.col("unit_price") - F.col("unit_cost")
    stock = F.when(F.col("stock_quantity") == 0, "OUT_OF_STOCK").otherwise(
        ladder("stock_quantity", STOCK_LEVELS, "HIGH_STOCK")
    )
    return df.withColumns(
        {
            "unit_margin": margin,
            "margin_percentage": ratio(margin, "unit_price", 100),
            "price_tier": ladder("unit_price", PRICE_TIERS, TOP_PRICE_TIER),
            "stock_status": stock,
        }
    )


def clean_orders(df: DataFrame) -> DataFrame:
    out = df.withColumns(
        {
            "order_status": upper_code("order_status"),
            "payment_method": upper_code("payment_method"),
            "subtotal": F.col("subtotal").cast("decimal(12,2)"),
            "discount_amount": F.col("discount_amount").cast("decimal(10,2)"),
            "shipping_cost": F.col("shipping_cost").cast("decimal(10,2)"),
            "total_amount": F.col("total_amount").cast("decimal(12,2)"),
        }
    )
    calculated = F.col("subtotal") - F.col("discount_amount") + F.col("shipping_cost")
    out = out.withColumn("calculated_total", calculated.cast("decimal(12,2)"))
    return out.withColumnsRenamed({"created_at": "source_created_at", "updated_at": "source_updated_at"})


def total_matches(tolerance: str = TOTAL_TOLERANCE) -> Column:
    gap = F.abs(F.col("total_amount") - F.col("calculated_total"))
    return gap < F.lit(tolerance).cast("decimal(6,4)")


def validate_orders(df: DataFrame, strict: bool = False) -> DataFrame:
    """Three flags and the first failure as a label. Rows stay.

    A NULL flag counts as valid unless ``strict``, where it counts as a failure.
    """
    flags = {
        "is_total_valid": total_matches(),
        "is_status_valid": F.col("order_status").isin(*ORDER_STATUSES),
        "is_payment_valid": F.col("payment_method").isin(*PAYMENT_METHODS),
    }
    if strict:
        flags = {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}
    label = (
        F.when(~F.col("is_total_valid"), "INVALID_TOTAL")
        .when(~F.col("is_status_valid"), "INVALID_STATUS")
        .when(~F.col("is_payment_valid"), "INVALID_PAYMENT")
        .otherwise("VALID")
    )
    return df.withColumns(flags).withColumn("validation_status", label)


def derive_order_fields(df: DataFrame) -> DataFrame:
    """Replace a wrong total by the calculated one and add discount rate and date parts."""
    total = F.when(F.col("is_total_valid"), F.col("total_amount")).otherwise(F.col("calculated_total"))
    date = F.col("order_date")
    return df.withColumns(
        {
            "total_amount": total,
            "discount_percentage": ratio("discount_amount", "subtotal", 100),
            "order_date_key": F.to_date(date),
            "order_year": F.year(date),
            "order_month": F.month(date),
            "order_day": F.dayofmonth(date),
            "order_day_of_week": F.dayofweek(date),
        }
    )
