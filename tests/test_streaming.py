"""Streams over several files: replays, repeats, late rows."""

from datetime import datetime, timedelta

import pytest

from granary.sources.tables import LakeTable
from granary.streaming import runs
from workload import sinks

T0 = datetime(2024, 1, 1)
SCHEMA = "id string, v int, at timestamp"


def put(spark, folder, *rows):
    spark.createDataFrame([(k, v, T0 + timedelta(minutes=m)) for k, v, m in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return runs.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, max_files=1)


def got(table):
    return sorted((r["id"], r["v"]) for r in table.read().collect())


def test_merge_and_resume(spark, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    table = LakeTable(spark, str(tmp_path / "out"))

    def run():
        runs.ingest_merge(source(spark, folder), table, ["id"], ["at"], "s", "at", check).awaitTermination()

    put(spark, folder, ("a", 1, 0), ("a", 2, 5), ("b", 1, 0))
    run()
    assert got(table) == [("a", 2), ("b", 1)]
    put(spark, folder, ("b", 9, 10), ("c", 1, 10))
    run()
    run()
    assert got(table) == [("a", 2), ("b", 9), ("c", 1)]
    assert len(table.history(10)) == 2


def test_replayed_batch_is_skipped(spark, tmp_path):
    folder, check = str(tmp_path / "in"), tmp_path / "check"
    table = LakeTable(spark, str(tmp_path / "out"))
    put(spark, folder, ("a", 1, 0))
    runs.append_once(source(spark, folder), table, ["id"], ["at"], str(check)).awaitTermination()
    table.append(spark.createDataFrame([("x", 1, T0)], SCHEMA))  # another writer in between
    for name in ("0", ".0.crc"):  # Spark repeats a batch that was written but not marked as done
        (check / "commits" / name).unlink(missing_ok=True)
    runs.append_once(source(spark, folder), table, ["id"], ["at"], str(check)).awaitTermination()
    assert got(table) == [("a", 1), ("x", 1)] and len(table.history(10)) == 2


def test_two_streams_into_one_table(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "out"))
    for name in ("p", "q"):
        put(spark, str(tmp_path / name), (name, 1, 0))
        stream = source(spark, str(tmp_path / name))
        runs.append_once(stream, table, ["id"], ["at"], str(tmp_path / f"check-{name}")).awaitTermination()
    assert got(table) == [("p", 1), ("q", 1)]


def test_append_once_across_batches(spark, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    table = LakeTable(spark, str(tmp_path / "out"))
    for rows in ([("a", 1, 0), ("a", 1, 0)], [("a", 7, 9), ("b", 1, 0)]):
        put(spark, folder, *rows)
        runs.append_once(source(spark, folder), table, ["id"], ["at"], check).awaitTermination()
    assert got(table) == [("a", 1), ("b", 1)]


def test_windows_drop_late_rows(spark, tmp_path):
    folder, check, out = (str(tmp_path / n) for n in ("in", "check", "out"))

    def run():
        stream = source(spark, folder).selectExpr("id AS role", "v AS total_tokens", "CAST(v AS DECIMAL(14,2)) AS latency_ms", "at")
        df = runs.windowed_calls(stream, "at", "1 hour", "10 minutes")
        runs.to_parquet(df, out, check).awaitTermination()
        return df.schema

    put(spark, folder, ("a", 1, 5), ("a", 3, 59), ("a", 1, 65))
    run()
    put(spark, folder, ("a", 5, 30), ("a", 1, 200))  # the first is not late yet
    run()
    put(spark, folder, ("a", 100, 40), ("a", 1, 400))  # its window has closed
    schema = run()
    rows = {r["window_start"]: (r["calls"], r["tokens"], r["avg_latency_ms"]) for r in spark.read.schema(schema).parquet(out).collect()}
    assert rows[T0] == (3, 9, 3.0) and rows[T0 + timedelta(hours=1)] == (1, 1, 1.0) and rows[T0 + timedelta(hours=3)] == (1, 1, 1.0)


def test_drop_repeats(spark, tmp_path):
    folder, check, out = (str(tmp_path / n) for n in ("in", "check", "out"))
    for rows in ([("a", 1, 0), ("a", 2, 1)], [("a", 3, 2), ("b", 1, 2)]):
        put(spark, folder, *rows)
        df = runs.drop_repeats(source(spark, folder), ["id"], "at", "1 hour")
        runs.to_parquet(df, out, check).awaitTermination()
    assert sorted(r["id"] for r in spark.read.schema(df.schema).parquet(out).collect()) == ["a", "b"]


def test_freshness(spark, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    table = LakeTable(spark, str(tmp_path / "out"))
    for rows in ([("orders", 1, 0), ("items", 1, 30)], [("orders", 1, 20), ("orders", 1, 10)]):
        put(spark, folder, *rows)
        runs.newest_per_table(source(spark, folder), "id", "at", table, check).awaitTermination()
    state = runs.freshness_of(table.read(), "2024-01-01 01:00:00", 0.6)
    assert {r["id"]: (r["newest"], r["rows"], r["status"]) for r in state.collect()} == {
        "orders": (T0 + timedelta(minutes=20), 3, "STALE"),
        "items": (T0 + timedelta(minutes=30), 1, "FRESH"),
    }


@pytest.mark.parametrize("parts", [1, 3])
def test_table_of_one_file_or_a_folder_is_streamed_whole(spark, tmp_path, parts):
    rows = [(c, t, "user", f"{c} {t}") for c in range(20) for t in range(3)]
    talk = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    folder = str(tmp_path / "conversations.parquet")
    if parts == 1:
        talk.toPandas().to_parquet(folder)
    else:
        talk.repartition(parts).write.parquet(folder)
        spark.createDataFrame([(99, 0, "user", "another table")], talk.schema).write.parquet(str(tmp_path / "conversations.parquet_old"))
    out = sinks.stream_bronze_ingest(spark, str(tmp_path))
    assert sorted((r["conv_id"], r["turn"]) for r in out.collect()) == [r[:2] for r in rows]
