"""Tables of plain Parquet: overwrite, append, merge, replacement, and what any reader sees."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from granary.operators.bronze import SchemaMismatch
from granary.sources.contracts import ORDERS
from granary.sources.tables import DuplicateSourceKeys, LakeTable
from granary.sources.writer import BronzeWriter

SCHEMA = "id string, v int, d string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def batch(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


@pytest.mark.parametrize("partition_by", [[], ["d"]])
def test_merge_updates_inserts_and_repeats(spark, new_path, partition_by):
    t = LakeTable(spark, new_path(), partition_by)
    assert not t.exists()
    t.merge(batch(spark, ("a", 1, "x"), ("b", 1, "y"), ("c", 1, "y")), ["id"])
    update = batch(spark, ("b", 2, "y"), ("d", 2, "z"))
    first = t.merge(update, ["id"])
    want = [("a", 1, "x"), ("b", 2, "y"), ("c", 1, "y"), ("d", 2, "z")]
    assert rows(t.read()) == want and first["rows"] == 2
    t.merge(update, ["id"])
    assert rows(t.read()) == want
    plain = spark.read.parquet(t.path).select("id", "v", "d")
    assert rows(plain) == want and not list(os.listdir(t.path)).count("_commits")


def test_merge_moves_a_row_between_partitions(spark, new_path):
    t = LakeTable(spark, new_path(), ["d"])
    t.merge(batch(spark, ("a", 1, "x"), ("b", 1, "x")), ["id"])
    t.merge(batch(spark, ("a", 2, "y")), ["id"])
    assert rows(t.read()) == [("a", 2, "y"), ("b", 1, "x")]


def files(path):
    return {os.path.relpath(os.path.join(d, n), path) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_merge_rewrites_touched_partitions_only(spark, new_path):
    t = LakeTable(spark, new_path(), ["d"])
    t.merge(batch(spark, *[(f"k{j}", j, f"p {j % 5}") for j in range(50)]), ["id"])
    before = files(t.path)
    t.merge(batch(spark, ("k3", 99, "p 3")), ["id"])
    assert {f.split("/")[0] for f in before ^ files(t.path)} == {"d=p 3"}
    assert t.read().count() == 50 and t.read().filter("v = 99").count() == 1


def test_odd_partition_values(spark, new_path):
    t = LakeTable(spark, new_path(), ["d"])
    values = ["a/b", "c:d", "e=f", "%", " ", None, "é", "x'y"]
    t.merge(batch(spark, *[(f"k{j}", j, v) for j, v in enumerate(values)]), ["id"])
    t.merge(batch(spark, *[(f"k{j}", j + 100, "new") for j in range(len(values))]), ["id"])
    assert rows(t.read()) == [(f"k{j}", j + 100, "new") for j in range(len(values))]
    assert {f.split("/")[0] for f in files(t.path)} == {"d=new"}


def test_merges_by_other_keys_than_the_buckets(spark, new_path):
    t = LakeTable(spark, new_path())
    t.append(batch(spark, ("a", 1, "x"), ("b", 1, "y")))
    t.merge(batch(spark, ("c", 3, "z")), ["id"])
    t.merge(batch(spark, ("q", 3, "w")), ["v"])
    t.merge(batch(spark, ("a", 9, "x")), ["id", "d"])
    assert rows(t.read()) == [("a", 9, "x"), ("b", 1, "y"), ("q", 3, "w")]


def test_repeated_keys_in_a_batch_fail_and_leave_the_table(spark, new_path):
    t = LakeTable(spark, new_path())
    t.merge(batch(spark, ("a", 1, "x")), ["id"])
    with pytest.raises(DuplicateSourceKeys):
        t.merge(batch(spark, ("a", 2, "x"), ("a", 3, "x")), ["id"])
    assert rows(t.read()) == [("a", 1, "x")]


def test_null_keys_never_match_unless_asked(spark, new_path):
    t = LakeTable(spark, new_path())
    t.merge(batch(spark, (None, 1, "x")), ["id"])
    t.merge(batch(spark, (None, 2, "x")), ["id"])
    assert t.read().count() == 2
    s = LakeTable(spark, new_path("s"))
    s.merge(batch(spark, (None, 1, "x")), ["id"])
    s.merge(batch(spark, (None, 2, "x")), ["id"], null_safe=True)
    assert rows(s.read()) == [(None, 2, "x")]


def test_new_and_missing_columns(spark, new_path):
    t = LakeTable(spark, new_path())
    t.merge(batch(spark, ("a", 1, "x"), ("b", 1, "x")), ["id"])
    t.merge(spark.createDataFrame([("b", 5, True)], "id string, v int, extra boolean"), ["id"])
    got = {r["id"]: (r["v"], r["d"], r["extra"]) for r in t.read().collect()}
    assert got == {"a": (1, "x", None), "b": (5, None, True)}


def test_partial_update(spark, new_path):
    t = LakeTable(spark, new_path())
    t.merge(batch(spark, ("a", 1, "x")), ["id"])
    t.merge(batch(spark, ("a", 2, "y"), ("b", 3, "z")), ["id"], update_columns=["v"])
    assert rows(t.read()) == [("a", 2, "x"), ("b", 3, "z")]


def test_append_once(spark, new_path):
    t = LakeTable(spark, new_path(), ["d"])
    t.append(batch(spark, ("a", 1, "x")), ["id"])
    t.append(batch(spark, ("a", 1, "x"), ("b", 1, "x")), ["id"])
    assert rows(t.read()) == [("a", 1, "x"), ("b", 1, "x")]
    t.append(batch(spark, ("a", 1, "x")))
    assert t.read().count() == 3


def test_overwrite_may_change_the_schema(spark, new_path):
    t = LakeTable(spark, new_path())
    t.overwrite(batch(spark, ("a", 1, "x")))
    t.overwrite(spark.range(3))
    assert t.read().columns == ["id"] and t.read().count() == 3
    info = t.info()
    assert (info["row_count"], info["latest_version"], info["column_count"]) == (3, 2, 1)
    assert [o["operation"] for o in info["recent_operations"]] == ["overwrite", "overwrite"]


def test_empty_batches(spark, new_path):
    t = LakeTable(spark, new_path(), ["d"])
    empty = batch(spark, ("a", 1, "x")).filter("false")
    t.merge(empty, ["id"])
    assert t.read().count() == 0
    t.merge(batch(spark, ("a", 1, "x")), ["id"])
    t.merge(empty, ["id"])
    assert rows(t.read()) == [("a", 1, "x")]


def order(n, **more):
    base = dict(
        order_id=f"o{n}", customer_id="c", order_date="2024-01-01 10:00:00", order_status="PENDING", shipping_address="s",
        payment_method="PIX", subtotal="10.00", discount_amount="0", shipping_cost="0", total_amount="10.00",
        created_at="2024-01-01 10:00:00", updated_at="2024-01-01 10:00:00",
    )
    return {**base, **more}


def test_writer_validates_stamps_and_reports(spark, new_path):
    w = BronzeWriter(spark, new_path("lake"))
    df = spark.createDataFrame([order(1), order(2, order_status="SHIPPED")])
    first = w.write(df, "orders", "shop", ["order_id"], batch_id="b1", expected_schema=ORDERS.schema(), ingested_at=datetime(2024, 1, 1))
    assert (first["rows_affected"], first["operation"], first["version"]) == (2, "overwrite", 1)
    w.write(df, "orders", "shop", ["order_id"], batch_id="b2", expected_schema=ORDERS.schema(), ingested_at=datetime(2024, 1, 2))
    out = w.table("orders").read()
    assert out.count() == 2 and {r[0] for r in out.select("_batch_id").distinct().collect()} == {"b2"}
    assert dict(out.dtypes)["total_amount"] == "decimal(12,2)"
    with pytest.raises(SchemaMismatch, match="customer_id"):
        w.write(df.drop("customer_id"), "orders", "shop", ["order_id"], expected_schema=ORDERS.schema())
    with pytest.raises(ValueError, match="mode"):
        w.write(df, "orders", "shop", ["order_id"], mode="upsert")


def test_append_mode_skips_a_repeated_batch(spark, new_path):
    w = BronzeWriter(spark, new_path("lake"))
    df = batch(spark, ("a", 1, "x"))
    for b in ("b1", "b1", "b2"):
        w.write(df, "t", "s", ["id"], mode="append", batch_id=b, ingested_at=datetime(2024, 1, 1))
    assert sorted(r[0] for r in w.table("t").read().select("_batch_id").collect()) == ["b1", "b2"]


def test_quarantine(spark, new_path):
    w = BronzeWriter(spark, new_path("lake"))
    for b in ("b1", "b2"):
        w.quarantine(batch(spark, ("a", 1, "x")), "t", "bad", b, source_system="s")
    out = w.table("t_quarantine").read()
    assert out.count() == 2 and out.filter(F.col("_quarantine_reason") == "bad").count() == 2


def test_append_twice_with_a_missing_key(spark, new_path):
    t = LakeTable(spark, new_path())
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    t.append(rows, ["k"])
    t.append(rows, ["k"])
    assert t.read().count() == 2


def test_replace_takes_all_rows_of_the_touched_keys(spark, new_path):
    t = LakeTable(spark, new_path(), ["p"])
    t.replace(spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "c", "x"), (None, "d", "x")], "k int, v string, p string"), ["k"])
    t.replace(spark.createDataFrame([(1, "e", "z"), (1, "f", "z"), (None, "g", "x")], "k int, v string, p string"), ["k"])
    assert sorted(r["v"] for r in t.read().collect()) == ["c", "e", "f", "g"]
    assert t.history(1)[0]["operation"] == "replace"


def test_merges_of_few_keys_leave_other_buckets_alone(spark, new_path):
    t = LakeTable(spark, new_path())
    t.merge(spark.range(1000).selectExpr("id as k", "0 as v"), ["k"])
    before = files(t.path)
    t.merge(spark.range(25, 27).selectExpr("id as k", "9 as v"), ["k"])
    assert len({f.split("/")[0] for f in before ^ files(t.path)}) <= 2 and t.read().count() == 1000
    assert sorted(r["k"] for r in t.read().filter("v = 9").collect()) == [25, 26]


def test_a_failed_write_leaves_the_rows(spark, new_path):
    t = LakeTable(spark, new_path())
    t.merge(batch(spark, ("a", 1, "x"), ("b", 1, "x")), ["id"])
    broken = batch(spark, ("a", 2, "x")).withColumn("v", F.expr("cast(raise_error('no') as int)"))
    with pytest.raises(Exception, match="no"):
        t.merge(broken, ["id"])
    assert rows(t.read()) == [("a", 1, "x"), ("b", 1, "x")] and len(t.history()) == 1


def test_merge_across_many_partitions_of_two_columns(spark, new_path):
    t = LakeTable(spark, new_path(), ["d", "e"])
    row = lambda j, v: (f"k{j}", v, f"d{j % 9}", j % 8)
    make = lambda rows: spark.createDataFrame(rows, "id string, v int, d string, e int")
    t.merge(make([row(j, 0) for j in range(200)]), ["id"])
    t.merge(make([row(j, 1) for j in range(150)]), ["id"])
    assert sorted((r.id, r.v) for r in t.read().collect()) == sorted((f"k{j}", int(j < 150)) for j in range(200))
