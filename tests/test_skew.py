"""Neighbour columns of hot keys against a plain Python pass."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from granary.operators import skew

T0 = datetime(2024, 1, 1)


def rows(seed=5, n=500):
    rng = random.Random(seed)
    out = []
    for j in range(n):
        key = rng.choice(["hot", "hot", "hot", "b", "c", None])
        out.append((key, T0 + timedelta(minutes=j * 7 % 3001), rng.choice([None, rng.randrange(100)]), j))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "k string, at timestamp, v int, id int")


def ordered(data):
    by_key = {}
    for r in data:
        by_key.setdefault(r[0], []).append(r)
    return [sorted(g, key=lambda r: (r[1], r[3])) for g in by_key.values()]


@pytest.mark.parametrize("split_rows", [None, 3, 30, 100000])
def test_neighbours(spark, split_rows):
    data = rows()
    out = skew.with_neighbours(
        frame(spark, data), ["k"], ["at", "id"], {"pv": "v", "pid": "id"}, {"nid": "id"}, split_rows=split_rows
    )
    got = {r["id"]: (r["pv"], r["pid"], r["nid"], r["_has_previous"], r["_has_following"]) for r in out.collect()}
    want = {}
    for group in ordered(data):
        for j, r in enumerate(group):
            p = group[j - 1] if j else None
            n = group[j + 1] if j + 1 < len(group) else None
            want[r[3]] = (p and p[2], p and p[3], n and n[3], p is not None, n is not None)
    assert got == want


@pytest.mark.parametrize("split_rows", [None, 3, 30])
def test_carry_forward(spark, split_rows):
    data = rows(seed=9)
    df = frame(spark, data)
    out = skew.per_part(df, ["k"], ["at", "id"], lambda p: skew.carry_forward(p, ["k"], ["at", "id"], "v"), split_rows)
    want = {}
    for group in ordered(data):
        last = None
        for r in group:
            last = r[2] if r[2] is not None else last
            want[r[3]] = last
    assert {r["id"]: r["v"] for r in out.collect()} == want


def test_one_instant_and_ordinary_keys_only(spark):
    same = [("hot", T0, j, j) for j in range(50)] + [("b", T0, 1, 99)]
    out = skew.with_neighbours(frame(spark, same), ["k"], ["at", "id"], {"p": "id"}, split_rows=10)
    got = {r["id"]: r["p"] for r in out.collect()}
    assert got == {0: None, 99: None, **{j: j - 1 for j in range(1, 50)}}
    cold, hot = skew.split_hot(frame(spark, same), ["k"], ["at", "id"], 1000)
    assert hot is None and cold.count() == 51


def test_hot_rows_spread_over_many_slices(spark):
    data = [("hot", T0 + timedelta(hours=j), j, j) for j in range(400)]
    _, hot = skew.split_hot(frame(spark, data), ["k"], ["at", "id"], 100)
    sizes = [r["count"] for r in hot.groupBy(skew.SLICE).count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 100


def test_a_burst_equal_times_and_missing_times_are_cut_by_rows(spark):
    day = T0 + timedelta(days=1500)
    data = [("hot", T0 + timedelta(days=j), j, j) for j in range(10)] + [("hot", day, j, j) for j in range(10, 10_000)]
    data += [("hot", None, j, j) for j in range(10_000, 20_000)]
    _, hot = skew.split_hot(frame(spark, data), ["k"], ["at", "id"], 1000)
    sizes = [r["count"] for r in hot.groupBy(skew.SLICE).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2000
    out = skew.with_neighbours(frame(spark, data), ["k"], ["at", "id"], {"p": "id"}, split_rows=1000)
    in_order = [r[3] for r in sorted(data, key=lambda r: (r[1] is not None, r[1] or T0, r[3]))]
    assert {r["id"]: r["p"] for r in out.collect()} == dict(zip(in_order, [None, *in_order], strict=False))


def test_hot_join_keys_are_split_while_the_join_runs(spark):
    left = spark.range(200_000).selectExpr("if(id % 10 < 9, 'hot', cast(id as string)) as k", "id")
    right = left.groupBy("k").agg(F.count("*").alias("v"))
    held = {"autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(f"spark.sql.{k}") for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(f"spark.sql.{k}", v)
        out = skew.join_unique(left.repartition(8), right, ["k"])
        assert out.agg(F.sum("v")).first()[0] == 180_000**2 + 20_000
        counted = out.filter("v > 1")
        assert counted.count() == 180_000
    finally:
        for k, v in old.items():
            spark.conf.set(f"spark.sql.{k}", v)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_unique(spark, how):
    rng = random.Random(8)
    left = [(rng.choice(["hot", "hot", "gone", "b", "c", None, None]), j) for j in range(300)]
    right = [("hot", 1), ("b", 2), ("z", 3)]
    lookup = dict(right)
    a = spark.createDataFrame(left, "k string, id int")
    b = spark.createDataFrame(right, "k string, v int")
    got = sorted(skew.join_unique(a, b, ["k"], how).collect(), key=lambda r: r["id"])
    if how == "left_anti":
        want = [(k, j) for k, j in left if k not in lookup]
    elif how == "left_semi":
        want = [(k, j) for k, j in left if k in lookup]
    elif how == "left":
        want = [(k, j, lookup.get(k)) for k, j in left]
    else:
        want = [(k, j, lookup[k]) for k, j in left if k in lookup]
    assert [tuple(r) for r in got] == want
