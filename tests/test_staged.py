"""Large steps are written before the next one reads them, and leave no shuffle files behind."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from granary.operators import scd2, skew
from granary.plans import gold
from granary.session import CLEANUP, shuffles_deleted, stage
from granary.sources.tables import LakeTable
from tests.test_cleaning_gold import small_star
from workload import inputs

ROWS = {
    "nation": "select cast(id as int) as n_nationkey, concat('n', id) as n_name, 0 as n_regionkey from range(3)",
    "customer": "select id as c_custkey, concat('Customer#', id) as c_name, cast(id % 3 as int) as c_nationkey, 600.0D as c_acctbal, 'M' as c_mktsegment from range(9)",
    "part": "select id as p_partkey, concat('old ring', id) as p_name, 'Brand#1' as p_brand, 'LARGE' as p_type, cast(id as int) as p_size, 900.0D + id as p_retailprice from range(12)",
    "orders": """select id as o_orderkey, id % 9 as o_custkey, element_at(array('F', 'O'), cast(id % 2 + 1 as int)) as o_orderstatus, 100.0D * id as o_totalprice,
      timestamp_ntz'1998-10-01' + make_dt_interval(cast(id * 5 as int)) as o_orderdate, '1-URGENT' as o_orderpriority from range(60)""",
    "lineitem": """select id % 60 as l_orderkey, id * 7 % 12 as l_partkey, 0L as l_suppkey, cast(id div 60 % 5 as int) as l_linenumber, 2.0D as l_quantity, 10.0D + id % 13 as l_extendedprice,
      0.05D as l_discount, 0.01D as l_tax, 'N' as l_returnflag, 'O' as l_linestatus, timestamp_ntz'1998-06-01' + make_dt_interval(cast(id * 11 % 400 as int)) as l_shipdate from range(400)""",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    for name, sql in ROWS.items():
        spark.createDataFrame(spark.sql(sql).collect(), inputs.SCHEMAS[name]).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(j).getName() for j in range(found.size())) if n.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that came since, once deletions in the background have had their time."""
    for _ in range(40):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return new


def steps(df, name):
    return df._jdf.queryExecution().optimizedPlan().toString().count(name)


def test_stage_keeps_rows_and_no_shuffles(spark):
    before, was = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    out = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")), "t")
    assert not left_over(spark, before) and sorted(out.collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]
    with pytest.raises(ZeroDivisionError), shuffles_deleted(spark):
        raise ZeroDivisionError
    assert spark.conf.get(CLEANUP, None) == was


def test_keys_of_a_join_are_shuffled_once(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    out = skew.join_unique(left.repartition(2), spark.createDataFrame([("a", 9)], "k string, w int"), ["k"], "left")
    assert sorted(out.collect(), key=lambda r: r["v"]) == [("a", 1, 9), (None, 2, None), ("b", 3, None)]
    below = out._jdf.queryExecution().optimizedPlan().children().head().children().head().output()
    assert sorted(below.apply(j).name() for j in range(below.size())) == ["_left_key", "v"]


def test_staged_fact(spark):
    head, lines, product = small_star(spark)
    before = shuffle_files(spark)
    out = gold.fact_sales(lines, head, product, staged=True)
    assert not left_over(spark, before)
    assert sorted(out.collect()) == sorted(gold.fact_sales(lines, head, product).collect())


@pytest.mark.parametrize("name", ["fact_sales", "fact_sales_hot_keys", "join_star"])
def test_facts_run_one_join_at_a_time(spark, folder, name):
    out = entry_points.queries()[name](spark, folder)
    assert steps(out, "Join ") == 1 and steps(out, "Aggregate ") == 0
    assert out.count() == 300  # 400 lines, of which 100 come again


def test_sliced_neighbours_move_each_row_once(spark):
    df = spark.range(90).selectExpr("'k' as k", "id as at", "id * 2 as v", f"id div 10 as {skew.SLICE}")
    out = skew.neighbours(df, ["k"], ["at"], {"pv": "v"}, {"nv": "v"})
    assert sorted((r["at"], r["pv"], r["nv"]) for r in out.collect()) == [(j, 2 * j - 2 if j else None, 2 * j + 2 if j < 89 else None) for j in range(90)]
    assert steps(out, "Join ") == 0


def test_histories_read_their_feed_once(spark, folder):
    for name in ("scd2_hot_keys", "scd2_incremental", "sink_model_incremental"):
        out = entry_points.queries()[name](spark, folder)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan and "p_partkey" not in plan, name
        assert out.count() == entry_points.queries()["scd2_products"](spark, folder).count(), name


def test_hot_history_leaves_no_shuffles(spark):
    rows = spark.range(300).selectExpr("concat('k', id % 2) as k", "id % 5 div 3 as v", "timestamp_seconds(id * 60) as at")
    before = shuffle_files(spark)
    out = scd2.build_history(rows, "k", ["v"], "at", split_rows=20)
    assert len({n.split("_")[1] for n in left_over(spark, before)}) <= 1  # of the sum over the hot keys
    columns = ["k", "at", "valid_to", "_row_hash", "surrogate_key", "is_current"]
    plain = scd2.build_history(rows, "k", ["v"], "at", split_rows=None)
    assert out.columns == plain.columns and sorted(out.select(columns).collect()) == sorted(plain.select(columns).collect())


def test_many_hot_keys_leave_the_others_written(spark, monkeypatch):
    monkeypatch.setattr(skew, "MANY_KEYS", 1)
    df = spark.range(100).selectExpr("id % 3 + int(id > 89) * 5 as k", "id as at")
    cold, hot = skew.split_hot(df, ["k"], ["at"], split_rows=20)
    assert steps(cold, "Join ") == 0 and cold.count() == 10 and hot.count() == 90


def test_a_large_merge_goes_group_by_group(spark, tmp_path):
    make = lambda lo, hi, v: spark.range(lo, hi).selectExpr("id as k", f"{v} as v")
    seen, t = [], LakeTable(spark, str(tmp_path / "t"), group_bytes=2000)
    t.merge(make(0, 500, 0), ["k"])
    write = t._write
    t._write = lambda df, mode, dynamic=False: seen.append(write(df, mode, dynamic)) or seen[-1]
    gone = stage(spark.range(1), "t")
    t.merge(make(400, 600, 1), ["k"], sources=[gone])
    assert len(seen) > 4 and sum(seen) == 600
    assert sorted((r["k"], r["v"]) for r in t.read().collect()) == [(k, int(k >= 400)) for k in range(600)]
    assert not t._is_there(gone.written_to)
    n = len(seen)
    t.append(make(900, 901, 2))
    t.merge(make(900, 901, 3), ["k"], ["v"])
    assert len(seen) == n + 2  # with given columns all at once
    t.replace(make(0, 3, 4), ["k"])
    assert t.read().count() == 601 and t.read().filter("v = 4").count() == 3 and t.read().filter("v = 3").count() == 1


def test_facts_in_two_runs(spark, folder):
    found = entry_points.queries()
    once = found["fact_sales"](spark, folder).select("order_item_id", "order_status", "net_revenue", "gross_profit")
    assert sorted(found["sink_fact_incremental"](spark, folder).collect()) == sorted(once.collect())
