"""Contracts, JDBC options, paths, call files."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from granary.session import shared_dir, spread
from granary.sources import calls, contracts, jdbc, paths


def test_contract_schema():
    s = contracts.ORDERS.schema()
    assert s["total_amount"].dataType == T.DecimalType(12, 2) and not s["total_amount"].nullable
    assert s["shipping_address"].metadata == {"pii": True, "mask": "full", "description": ""}
    assert [len(c.fields) for c in contracts.RETAIL.values()] == [15, 12, 12, 8, 11]


def test_rules_as_rows(spark):
    rules = contracts.rules_table(spark)
    assert rules.filter("kind = 'uniqueness'").count() == 5
    assert rules.filter("severity = 'warning'").count() == 3


def test_yaml_contracts(tmp_path):
    pytest.importorskip("yaml")
    file = tmp_path / "c.yaml"
    file.write_text(
        """
things:
  source_system: erp
  sla: {freshness_hours: 6}
  schema:
    fields:
      - {name: id, type: string, nullable: false}
      - {name: price, type: decimal, precision: 8, scale: 3, pii: true, masking_strategy: hash}
      - {name: kind, type: string, allowed_values: [A, B], default: A}
  quality_rules:
    - {rule: id_unique, type: uniqueness, columns: [id]}
    - {rule: owner_exists, type: referential_integrity, target_table: owners, target_column: owner_id}
"""
    )
    c = contracts.load_yaml(file)["things"]
    assert c.schema()["price"].dataType == T.DecimalType(8, 3) and c.keys == ("id",) and c.freshness_hours == 6
    assert [r.name for r in c.all_rules()] == ["id_not_null", "kind_allowed", "id_unique", "owner_exists"]
    assert c.rules[1].columns == ("owner_id",)


def test_jdbc_options():
    src = jdbc.JdbcSource("oracle", "jdbc:oracle:thin:@h:1/s", "u", "p")
    full = src.options("CRM.CUSTOMERS")
    assert full["dbtable"] == "(SELECT * FROM CRM.CUSTOMERS) src" and full["fetchsize"] == "10000"
    some = src.options(
        "T", "ID", (1, 9), watermark_column="UPDATED_AT", watermark=datetime(2024, 1, 2, 3, 4, 5)
    )
    assert "TO_TIMESTAMP('2024-01-02T03:04:05'" in some["dbtable"]
    assert (some["partitionColumn"], some["lowerBound"], some["upperBound"], some["numPartitions"]) == ("ID", "1", "9", "4")
    other = jdbc.JdbcSource("sqlserver", "jdbc:sqlserver://h", "u", "p").options("dbo.T", "id", (0, 1), watermark_column="u", watermark=datetime(2024, 1, 2))
    assert other["numPartitions"] == "8" and "u > '2024-01-02 00:00:00'" in other["dbtable"]
    for bad in ({"partition_column": "ID"}, {"bounds": (0, 1)}, {"watermark_column": "U"}):
        with pytest.raises(ValueError):
            src.options("T", **bad)
    with pytest.raises(ValueError, match="dialect"):
        jdbc.JdbcSource("db2", "", "", "").options("T")


def test_paths():
    assert paths.LakePaths("/lake/").table("silver", "t") == "/lake/silver/t"
    assert paths.azure("c", "acc").layer("bronze") == "abfss://c@acc.dfs.core.windows.net/bronze"
    assert paths.google("b", "root").layer("gold") == "gs://b/root/gold"
    assert paths.amazon("b").layer("gold") == "s3a://b/gold"
    assert paths.local("/x").layer("gold") == "file:///x/gold"
    with pytest.raises(ValueError):
        paths.LakePaths("/lake").layer("platinum")


def test_typed_rows(spark):
    row = ("S1", "n", "OUTLET", "r", "c", "s", None, datetime(2020, 1, 1).date(), True, datetime(2024, 1, 1), datetime(2024, 1, 1))
    df = spark.createDataFrame([row], contracts.STORES.schema())
    assert df.schema["store_id"].nullable is False and df.count() == 1


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_call_files(spark, tmp_path, fmt):
    row = ("1", datetime(2024, 1, 1), "chat", "mock", 1, 2, 3, Decimal("1.50"), Decimal("0.1000000"), None, None, None, 0, True, None)
    df = spark.createDataFrame([row], calls.CALL_SCHEMA)
    for _ in range(2):
        calls.write_calls(df, str(tmp_path / fmt), fmt)
    assert [tuple(r) for r in calls.read_calls(spark, str(tmp_path / fmt), fmt).collect()] == [row, row]


def test_call_array_file(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"call_id": "1", "timestamp": "2024-01-01T10:00:00", "role": "chat"},\n {"call_id": "2"}]')
    out = calls.read_calls(spark, str(tmp_path / "m.json"), multi_line=True)
    assert sorted(r["call_id"] for r in out.collect()) == ["1", "2"]


def test_shared_dir_and_spread(spark):
    assert shared_dir(spark) == shared_dir(spark)
    few = spark.range(100, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=64)
    assert spread(many) is many
