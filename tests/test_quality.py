"""Rules, gates, freshness and scores."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from granary.operators import quality
from granary.sources.contracts import ORDERS, Rule

SCHEMA = "id string, parent string, email string, n int, at timestamp"
T = datetime(2024, 1, 1)


def frame(spark):
    return spark.createDataFrame(
        [("a", "p", "x@y.zz", 1, T), ("a", "q", "bad", 5, T), ("b", None, None, None, T), (None, "p", "u@v.ww", -1, None)], SCHEMA
    )


RULES = [
    Rule("id_not_null", "not_null", ("id",)),
    Rule("n_small", "comparison", expression="n < 5"),
    Rule("n_values", "accepted_values", ("n",), values=("1", "5"), severity="warning"),
    Rule("email_format", "regex", ("email",), pattern="^[^@]+@[^@]+$", severity="warning"),
    Rule("id_unique", "uniqueness", ("id",)),
    Rule("parent_exists", "referential_integrity", ("parent",), target_table="parents", target_column="id"),
]


def test_all_rule_kinds(spark):
    parents = spark.createDataFrame([("p",), ("p",)], "id string")
    out = quality.run_rules(frame(spark), "t", RULES, {"parents": parents})
    got = {r["rule"]: (r["rows_checked"], r["violations"], r["status"]) for r in out.collect()}
    assert got == {
        "id_not_null": (4, 1, "FAIL"),
        "n_small": (4, 1, "FAIL"),
        "n_values": (4, 1, "WARN"),
        "email_format": (4, 1, "WARN"),
        "id_unique": (3, 1, "FAIL"),
        "parent_exists": (3, 1, "FAIL"),
    }
    s = quality.run_summary(out).first()
    assert (s["tests_run"], s["tests_passed"], s["tests_failed"], s["critical_failed"], s["status"]) == (6, 0, 6, 4, "FAILED")


def test_empty_table_passes(spark):
    parents = spark.createDataFrame([], "id string")
    out = quality.run_rules(frame(spark).filter("false"), "t", RULES, {"parents": parents})
    assert {r["status"] for r in out.collect()} == {"PASS"}
    with pytest.raises(ValueError, match="parents"):
        quality.run_rules(frame(spark), "t", RULES)


def test_gate_splits_every_row_once(spark):
    valid, bad = quality.severity_gate(frame(spark), RULES)
    assert valid.count() + bad.count() == 4
    reasons = sorted(tuple(r["_quarantine_reasons"]) for r in bad.collect())
    assert reasons == [("id_not_null",), ("n_small",)]
    assert sorted(tuple(r["_warnings"]) for r in valid.collect()) == [(), ()]


def test_orphans(spark):
    items = spark.createDataFrame([("i1", "o1"), ("i2", "o2"), ("i3", None), ("i4", "o1")], "item string, order_id string")
    heads = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    valid, bad = quality.split_orphans(items, heads)
    assert sorted(r["item"] for r in valid.collect()) == ["i1", "i4"]
    assert sorted(r["item"] for r in bad.collect()) == ["i2", "i3"]
    assert [r["item"] for r in quality.orphans(items, heads, "order_id", "order_id").collect()] == ["i2"]


@pytest.mark.parametrize("as_of,status", [("2024-01-01 01:00:00", "PASS"), ("2024-01-01 03:00:00", "WARN"), ("2024-01-02 00:00:00", "ERROR")])
def test_freshness(spark, as_of, status):
    assert quality.freshness(frame(spark), "t", as_of, 2, 6, "at").first()["status"] == status


def test_freshness_of_an_empty_table(spark):
    assert quality.freshness(frame(spark).filter("false"), "t", "2024-01-01", 2, 6, "at").first()["status"] == "ERROR"


def test_table_quality_and_overall(spark):
    q = quality.table_quality(frame(spark), "t", ["id", "email"], ["id"], {"email": "int"})
    r = q.first()
    assert (r["row_count"], r["null_violations"], r["unique_violations"], r["type_violations"]) == (4, 2, 1, 3)
    assert r["quality_score"] == 62.5
    good = quality.table_quality(frame(spark).filter("id = 'b'"), "u", ["id"], ["id"])
    assert good.first()["quality_score"] == 100.0
    assert quality.overall_quality(q.unionByName(good)).first()["overall_score"] == 70.0


def test_scorecard(spark):
    r = quality.scorecard(frame(spark), "t", "silver", ["id", "email"], ["id"], RULES[:2], "at", "2024-01-01 05:00:00", 6).first()
    assert (r["completeness"], r["uniqueness"], r["validity"], r["freshness"]) == (75.0, 75.0, 75.0, 75.0)
    assert (r["overall"], r["band"], r["tests_passed"], r["tests_failed"]) == (75.0, "RED", 0, 3)
    bands = spark.createDataFrame([(99.0,), (98.0,), (97.9,), (94.0,)], "s double").select(quality.score_band("s"))
    assert [b[0] for b in bands.collect()] == ["GREEN", "GREEN", "YELLOW", "RED"]


def test_contract_rules_cover_nullability_and_allowed_values():
    names = {r.name for r in ORDERS.all_rules()}
    assert {"order_id_not_null", "order_status_allowed", "total_calculation", "customer_exists"} <= names


def test_trend(spark):
    rows = [("2024-01-01", "bronze", 10, 9), ("2024-01-01", "silver", 4, 4), ("2024-01-02", "bronze", 2, 1)]
    df = spark.createDataFrame(rows, "day string, layer string, checks long, passed long")
    out = {r["day"]: (r["bronze"], r["silver"]) for r in quality.quality_trend(df, ["bronze", "silver"]).collect()}
    assert out == {"2024-01-01": (90.0, 100.0), "2024-01-02": (50.0, None)}
    assert df.agg(F.sum("checks")).first()[0] == 16
