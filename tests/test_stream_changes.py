"""Freshness changes, run rows of streams, stored sketches, nested schemas, daily quality states."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from granary.operators import quality_states, sketches
from granary.sources import nested
from granary.sources.tables import LakeTable
from granary.streaming import audit, freshness, runs

T0 = datetime(2024, 1, 1)
EVENTS = "name string, at timestamp"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def put(spark, folder, *rows):
    spark.createDataFrame([(k, T0 + timedelta(minutes=m)) for k, m in rows], EVENTS).coalesce(1).write.mode("append").parquet(folder)


def test_stale_and_fresh_across_batches(spark, tmp_path):
    folder, check, out = (str(tmp_path / n) for n in ("in", "check", "out"))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def run():
        stream = runs.file_stream(spark, folder, spark.createDataFrame([], EVENTS).schema, max_files=1)
        df = freshness.changes(stream, "name", "at", "60 minutes", "0 minutes", forget="20 days")
        runs.to_parquet(df, out, check).awaitTermination()
        return sorted((r.table_name, r.status, int((r.at - T0).total_seconds() // 60)) for r in spark.read.schema(df.schema).parquet(out).collect())

    try:
        put(spark, folder, ("a", 0), ("a", 5), ("b", 0), ("b", 50), ("a", 200), (None, 3))
        first = [("a", "FRESH", 200), ("a", "STALE", 65), ("b", "STALE", 110)]  # b is silent: the timer says so as a moves the time on
        assert run() == first
        put(spark, folder, ("b", 240), ("a", 230))
        assert run() == sorted([*first, ("b", "FRESH", 240)])
        put(spark, folder, ("b", 250), ("b", 310), ("c", 330))  # exactly the limit is no gap
        assert run() == sorted([*first, ("b", "FRESH", 240), ("a", "STALE", 290)])
    finally:
        spark.conf.set(PROVIDER, before)


def test_runs_and_failures_are_on_record(spark, tmp_path):
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "in"))
    listener = audit.RunAudit()
    spark.streams.addListener(listener)
    try:
        for name, column in (("fine", "id"), ("broken", "raise_error('lost')")):
            stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).selectExpr(f"{column} as x")
            writer = stream.writeStream.format("parquet").queryName(name).option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"check-{name}"))
            query = writer.trigger(availableNow=True).start()
            if name == "broken":
                with pytest.raises(Exception, match="lost"):
                    query.awaitTermination()
            else:
                query.awaitTermination()
            listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    found = listener.rows(spark)
    fine = found.filter("query = 'fine'").collect()
    assert len(fine) == 3 and sum(r.input_rows for r in fine) == 30 and {r.status for r in fine} == {"SUCCESS"} and len({r.run_id for r in fine}) == 1
    broken = found.filter("query = 'broken'").collect()
    assert [r.status for r in broken] == ["FAILED"] and "lost" in broken[0].error
    listener.flush(spark, str(tmp_path / "log"))
    listener.flush(spark, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4 and listener.rows(spark).count() == 0


def test_sketches_add_up(spark):
    df = spark.range(20000).selectExpr("id % 7000 as k", "date_add(date'2024-01-01', cast(id % 5 as int)) as d", "if(id % 3 = 0, 'x', null) as g")
    daily = sketches.daily_sketches(df, F.col("d"), ["g"], ["k"])
    assert daily.count() == 10
    for r in sketches.distinct_counts(daily, ["g"], ["k"]).collect():
        keys, rows = (6667, 6667) if r.g else (7000, 13333)
        assert abs(r.k_count - keys) < 0.03 * keys and r.rows == rows
    assert sketches.distinct_counts(daily.limit(0), ["g"], ["k"]).count() == 0


def test_nested_schema_and_fields(spark):
    rows = [('{"a": 1, "b": {"c": "x"}}', 1), ('{"a": 2.5, "b": {"d": [1]}}', 1), ("no json", 2), (None, 2)]
    df = nested.with_variant(spark.createDataFrame(rows, "props string, g int"), "props")
    got = {r.column_name: r.data_type for r in nested.nested_snapshot(df, "t", "props").collect()}
    assert set(got) == {"props.a", "props.b.c", "props.b.d"} and got["props.b.c"] == "string" and got["props.b.d"] == "array<bigint>"
    out = {r.g: (r.rows, r.a_filled, r.a_min, r.a_max) for r in nested.field_profile(df, "props", {"a": "double"}, ["g"]).collect()}
    assert out == {1: (2, 2, 1.0, 2.5), 2: (2, 0, None, None)}
    assert nested.nested_snapshot(df.limit(0), "t", "props").count() <= 1


def test_a_day_delivered_again_replaces_its_state(spark, new_path):
    table = LakeTable(spark, new_path())
    make = lambda rows: spark.createDataFrame(rows, "t timestamp, ok boolean, v int")
    state = lambda rows: quality_states.day_states(make(rows), "bronze", "t", F.col("ok"), ["v"])
    quality_states.save(table, state([(T0, True, 1), (T0, False, 5), (T0 + timedelta(days=1), None, None)]))
    quality_states.save(table, state([(T0 + timedelta(days=1), True, 9), (T0 + timedelta(days=2), True, 3)]))
    r = quality_states.totals(table, ["v"]).first()
    assert (r.checks, r.passed, r.v_filled, r.v_min, r.v_max) == (4, 3, 4, 1, 9)
    assert {str(x.day): x.bronze for x in quality_states.trend(table, ["bronze"]).collect()} == {"2024-01-01": 50.0, "2024-01-02": 100.0, "2024-01-03": 100.0}
