"""Silver models: staged orders (latest row per order) and type-2 customers and products."""

from __future__ import annotations

from pyspark.sql import DataFrame

from granary.operators.bronze import Run, audited
from granary.operators.cleaning import (
    clean_customers,
    clean_orders,
    clean_products,
    derive_order_fields,
    enrich_products,
    validate_orders,
)
from granary.operators.dedup import dedup_latest
from granary.operators.scd2 import CUSTOMER_TRACKED, PRODUCT_TRACKED, rebuild_touched, scd2_apply
from granary.operators.skew import SPLIT_ROWS


def latest_orders(df: DataFrame) -> DataFrame:
    return dedup_latest(df, ["order_id"], ["_ingestion_timestamp", "source_updated_at"])


def stg_orders(raw: DataFrame, strict: bool = False, run: Run | None = None) -> DataFrame:
    flagged = validate_orders(clean_orders(raw), strict)
    out = derive_order_fields(latest_orders(flagged))
    out = out.drop("calculated_total", "is_total_valid", "is_status_valid", "is_payment_valid")
    return audited(out, "silver.stg_orders", run)


def stg_customers(raw: DataFrame, history: DataFrame | None = None, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    return scd2_apply(history, clean_customers(raw), "customer_id", CUSTOMER_TRACKED, split_rows=split_rows)


def stg_products(raw: DataFrame, history: DataFrame | None = None, split_rows: int | None = SPLIT_ROWS, staged: bool = False) -> DataFrame:
    enriched = enrich_products(clean_products(raw))
    return scd2_apply(history, enriched, "product_id", PRODUCT_TRACKED, split_rows=split_rows, staged=staged)


def rebuilt_customers(feed: DataFrame, batch: DataFrame, split_rows: int | None = SPLIT_ROWS, staged: bool = False) -> DataFrame:
    """All versions of the customers in ``batch``, from all of their raw rows in ``feed``."""
    return rebuild_touched(clean_customers(feed), clean_customers(batch), "customer_id", CUSTOMER_TRACKED, split_rows=split_rows, staged=staged)


def rebuilt_products(feed: DataFrame, batch: DataFrame, split_rows: int | None = SPLIT_ROWS, staged: bool = False) -> DataFrame:
    """All versions of the products in ``batch``, from all of their raw rows in ``feed``."""
    cleaned = enrich_products(clean_products(feed)), enrich_products(clean_products(batch))
    return rebuild_touched(*cleaned, "product_id", PRODUCT_TRACKED, split_rows=split_rows, staged=staged)
