"""Every registered query of the library against its SQL on the smallest data."""

import os

import pytest

import __spark_entry__ as entry_points
import workload
from tools.check import compare, duck

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLES)
    assert set(workload.QUERIES) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["customer_segment", "revenue"] and df.count() == 4


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER).startswith("ok")
