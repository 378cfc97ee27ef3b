"""Structured Streaming: raw ingestion, idempotent append, windowed metrics, freshness.

Every sink is safe to replay: Spark's checkpoint holds how far a stream has come, and a micro-batch that Spark repeats after
a failure is merged, or appended by key, a second time without effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from granary.functions.numbers import mean
from granary.operators.bronze import stamp_metadata
from granary.operators.dedup import dedup_latest
from granary.sources.tables import LakeTable


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, name_filter: str = "*.parquet", max_files: int = 1000
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_filter)
    return reader.option("maxFilesPerTrigger", max_files).parquet(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """JSON messages of a topic; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def ingest_merge(
    stream: DataFrame,
    table: LakeTable,
    keys: list[str],
    order: list[str],
    source_system: str,
    ingested_at: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert each micro-batch into a raw table; the latest row per key of a batch wins.

    ``ingested_at`` names the event column used as ingestion time, so a replay writes the same rows.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch_id = f"stream-{epoch}"
        stamped = stamp_metadata(batch, source_system, batch_id, F.col(ingested_at).cast("timestamp"))
        table.merge(dedup_latest(stamped, keys, order), keys, batch_id=batch_id)

    return _start(stream.writeStream.foreachBatch(write), checkpoint, available_now)


def append_once(
    stream: DataFrame,
    table: LakeTable,
    keys: list[str],
    order: list[str],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Append only rows whose key is new to the table.

    Copies inside a batch are reduced before the shuffle, so many copies of one key stay cheap. Each
    batch reads the key columns of the table; ``drop_repeats`` bounds that by a time limit instead.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        table.append(dedup_latest(batch, keys, order), idempotency_keys=keys, batch_id=f"stream-{epoch}")

    return _start(stream.writeStream.foreachBatch(write), checkpoint, available_now)


def drop_repeats(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First row per key within the watermark, with bounded state."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_calls(
    stream: DataFrame, event_time: str, size: str, delay: str, slide: str | None = None, by: str = "role"
) -> DataFrame:
    """Calls, tokens and mean latency per time window and group; rows behind the watermark are dropped."""
    window = F.window(event_time, size, slide) if slide else F.window(event_time, size)
    out = stream.withWatermark(event_time, delay).groupBy(window.alias("w"), by)
    return out.agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("total_tokens").alias("tokens"),
        mean("latency_ms").alias("avg_latency_ms"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "calls", "tokens", "avg_latency_ms")


def to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    return _start(df.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint, available_now)


def newest_per_table(
    stream: DataFrame, table_column: str, event_time: str, table: LakeTable, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Keep the newest event time and row count per monitored table. State: one row per table."""
    newest = stream.groupBy(table_column).agg(F.max(event_time).alias("newest"), F.count(F.lit(1)).alias("rows"))

    def write(batch: DataFrame, epoch: int) -> None:
        table.merge(batch, [table_column], batch_id=f"stream-{epoch}")

    writer = newest.writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, checkpoint, available_now)


def freshness_of(newest: DataFrame, as_of: str, sla_hours: float) -> DataFrame:
    gap = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("newest")
    age = gap.cast("double") / F.lit(3.6e9)
    return newest.withColumns(
        {"age_hours": age, "status": F.when(age > sla_hours, "STALE").otherwise("FRESH")}
    )
