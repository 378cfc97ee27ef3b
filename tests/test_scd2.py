"""Type-2 history: edge cases, invariants, and the time-sliced path for hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from granary.operators import scd2

T0 = datetime(2024, 1, 1)
END = datetime(9999, 12, 31, 23, 59, 59)
SCHEMA = "id string, name string, city string, updated_at timestamp, _ingestion_timestamp timestamp"


def day(n):
    return T0 + timedelta(days=n)


def feed(spark, rows):
    return spark.createDataFrame([(k, n, c, day(u), day(i)) for k, n, c, u, i in rows], SCHEMA)


def history(df):
    cols = ["id", "name", "city", "valid_from", "valid_to", "is_current"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: (r[0], r[3]))


def build(spark, rows, **more):
    return scd2.build_history(feed(spark, rows), "id", ["name", "city"], "updated_at", **more)


def test_unchanged_row_opens_no_version(spark):
    out = history(build(spark, [("a", "x", "p", 0, 0), ("a", "x", "p", 5, 5)]))
    assert out == [("a", "x", "p", day(0), END, True)]


def test_two_changes_in_one_batch_close_each_other(spark):
    out = history(build(spark, [("a", "x", "p", 0, 0), ("a", "y", "p", 1, 1), ("a", "z", "p", 2, 1)]))
    assert [(r[1], r[3], r[4], r[5]) for r in out] == [
        ("x", day(0), day(1), False),
        ("y", day(1), day(2), False),
        ("z", day(2), END, True),
    ]


def test_equal_times_keep_the_last_ingested(spark):
    out = history(build(spark, [("a", "old", "p", 0, 0), ("a", "new", "p", 0, 1)]))
    assert out == [("a", "new", "p", day(0), END, True)]


def test_null_is_a_value_of_its_own(spark):
    out = history(build(spark, [("a", None, "p", 0, 0), ("a", None, "p", 1, 1), ("a", "x", "p", 2, 2)]))
    assert [(r[1], r[5]) for r in out] == [(None, False), ("x", True)]


def test_late_older_version_is_inserted_before(spark):
    first = build(spark, [("a", "y", "p", 10, 10)])
    late = feed(spark, [("a", "x", "p", 5, 11)])
    out = history(scd2.scd2_apply(first, late, "id", ["name", "city"], "updated_at"))
    assert [(r[1], r[3], r[4], r[5]) for r in out] == [("x", day(5), day(10), False), ("y", day(10), END, True)]


def test_rerun_of_a_batch_changes_nothing(spark):
    rows = [("a", "x", "p", 0, 0), ("b", "x", "q", 0, 0), ("a", "y", "p", 3, 3)]
    once = build(spark, rows)
    again = scd2.scd2_apply(once, feed(spark, rows), "id", ["name", "city"], "updated_at")
    assert history(again) == history(once)


def random_rows(n=400, seed=1):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", "d"]
    return [
        (rng.choice(keys), rng.choice(["x", "y", None]), rng.choice("pq"), rng.randrange(120), rng.randrange(200))
        for _ in range(n)
    ]


@pytest.mark.parametrize("split_rows", [None, 5, 40])
def test_invariants_and_hot_key_path(spark, split_rows):
    rows = random_rows()
    plain = history(build(spark, rows))
    assert history(build(spark, rows, split_rows=split_rows)) == plain
    by_key = {}
    for r in plain:
        by_key.setdefault(r[0], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r[3])
        assert [v[5] for v in versions] == [False] * (len(versions) - 1) + [True]
        for a, b in zip(versions, versions[1:]):
            assert a[4] == b[3] and (a[1], a[2]) != (b[1], b[2])


@pytest.mark.parametrize("cut", [20, 60, 110])
def test_two_batches_equal_one_rebuild(spark, cut):
    rows = random_rows(seed=cut)
    # rows of the second batch are ingested later, so ties resolve the same way
    rows = [(k, n, c, u, u if u < cut else 300 + i) for i, (k, n, c, u, _) in enumerate(rows)]
    rows = list({(r[0], r[3]): r for r in rows}.values())
    first = build(spark, [r for r in rows if r[3] < cut])
    second = feed(spark, [r for r in rows if r[3] >= cut])
    both = scd2.scd2_apply(first, second, "id", ["name", "city"], "updated_at")
    assert history(both) == history(build(spark, rows))


def test_change_labels(spark):
    current = build(spark, [("a", "x", "p", 0, 0), ("b", "x", "p", 0, 0)])
    incoming = feed(spark, [("a", "x", "p", 1, 1), ("b", "y", "p", 1, 1), ("c", "z", "p", 1, 1)])
    out = scd2.detect_changes(incoming, scd2.current_only(current), "id", ["name", "city"])
    assert dict(out.select("id", "change_type").collect()) == {"a": "NO_CHANGE", "b": "UPDATE", "c": "INSERT"}


def brute_as_of(facts, versions):
    out = []
    for key, at in facts:
        hit = [v for k, f, t, v in versions if k == key and f <= at < t]
        out.append((key, at, hit[0] if hit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split_rows", [None, 10])
def test_point_in_time_join(spark, split_rows):
    rng = random.Random(3)
    versions = []
    for key in ("hot", "a", "b"):
        starts = sorted(rng.sample(range(10, 300), 20 if key == "hot" else 3))
        ends = [day(s) for s in starts[1:]] + [END]
        versions += [(key, day(s), e, f"{key}{s}") for s, e in zip(starts, ends)]
    facts = [(rng.choice(["hot", "hot", "hot", "a", "none"]), day(rng.randrange(320))) for _ in range(300)]
    facts += [(k, f) for k, f, _, _ in versions]  # exactly at a boundary
    h = spark.createDataFrame(versions, "id string, valid_from timestamp, valid_to timestamp, label string")
    f = spark.createDataFrame(facts, "id string, at timestamp")
    out = scd2.join_as_of(f, h, "id", "at", ["label"], split_rows=split_rows)
    got = sorted(((r["id"], r["at"], r["asof_label"]) for r in out.collect()), key=str)
    assert got == brute_as_of(facts, versions)


def test_point_in_time_join_keeps_null_keys(spark):
    h = spark.createDataFrame([("a", T0, END, "v")], "id string, valid_from timestamp, valid_to timestamp, label string")
    f = spark.createDataFrame([(None, day(1)), ("a", None), ("a", day(1))], "id string, at timestamp")
    out = scd2.join_as_of(f, h, "id", "at", ["label"])
    assert sorted((str(r["id"]), str(r["asof_label"])) for r in out.collect()) == [("None", "None"), ("a", "None"), ("a", "v")]


def test_versions_at_counts_the_start_not_the_end(spark):
    h = build(spark, [("a", "x", "p", 0, 0), ("a", "y", "p", 5, 5)])
    at = scd2.versions_at(h, str(day(5)))
    assert [r["name"] for r in at.collect()] == ["y"]
    assert scd2.versions_at(h, "2023-12-31 00:00:00").filter(F.lit(True)).count() == 0
