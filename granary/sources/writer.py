"""Bronze writer: validate, stamp, write in one of three modes, report."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.bronze import PARTITION_COLUMN, enforce_schema, stamp_metadata
from granary.sources.tables import LakeTable

MODES = ("append", "merge", "overwrite")


class BronzeWriter:
    def __init__(self, spark: SparkSession, base_path: str):
        self.spark = spark
        self.base_path = base_path.rstrip("/")

    def table(self, name: str, partition_columns: list[str] | None = None) -> LakeTable:
        return LakeTable(self.spark, f"{self.base_path}/{name}", partition_columns or [PARTITION_COLUMN])

    def write(
        self,
        df: DataFrame,
        table_name: str,
        source_system: str,
        business_keys: list[str],
        mode: str = "merge",
        batch_id: str | None = None,
        expected_schema: T.StructType | None = None,
        partition_columns: list[str] | None = None,
        file_path: str | None = None,
        ingested_at: datetime | None = None,
    ) -> dict:
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        now = ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)
        batch_id = batch_id or now.strftime("%Y%m%d_%H%M%S_%f")
        checked = enforce_schema(df, expected_schema) if expected_schema is not None else df
        stamped = stamp_metadata(checked, source_system, batch_id, now, file_path)
        table = self.table(table_name, partition_columns)
        if mode == "overwrite":
            commit = table.overwrite(stamped, batch_id=batch_id)
        elif mode == "append":
            commit = table.append(stamped, idempotency_keys=[*business_keys, "_batch_id"], batch_id=batch_id)
        else:
            commit = table.merge(stamped, business_keys, batch_id=batch_id)
        return {
            "table_name": table_name,
            "table_path": table.path,
            "rows_affected": commit["rows"],
            "mode": mode,
            "batch_id": batch_id,
            "operation": commit["operation"],
            "version": commit["version"],
        }

    def quarantine(self, df: DataFrame, table_name: str, reason: str, batch_id: str, **stamp) -> dict:
        """Append rejected rows with their reason to ``<table>_quarantine``."""
        marked = df if "_quarantine_reason" in df.columns else df.withColumn("_quarantine_reason", F.lit(reason))
        source_system = stamp.pop("source_system", "unknown")
        at = stamp.pop("ingested_at", None) or datetime.now(timezone.utc).replace(tzinfo=None)
        stamped = stamp_metadata(marked, source_system, batch_id, at)
        return self.table(f"{table_name}_quarantine").append(stamped, batch_id=batch_id)
