"""Model-call events: layout, JSON and Parquet round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CALL_SCHEMA = (
    "call_id string, timestamp timestamp, role string, model string, input_tokens bigint, output_tokens bigint, "
    "total_tokens bigint, latency_ms decimal(14,2), cost_usd decimal(20,7), confidence_score decimal(6,4), "
    "human_approved boolean, query_type string, rag_chunks_used int, success boolean, error_message string"
)


def write_calls(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Append call events; one JSON object per line keeps the files splittable."""
    df.write.mode("append").format(fmt).save(path)


def read_calls(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False) -> DataFrame:
    """Read persisted call events. ``multi_line`` reads files that hold one JSON array each."""
    reader = spark.read.schema(CALL_SCHEMA)
    if fmt == "json":
        reader = reader.option("multiLine", multi_line)
    return reader.format(fmt).load(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def from_json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.from_json("json", CALL_SCHEMA).alias("c")).select("c.*")
