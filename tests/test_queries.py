"""The registered queries against DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tablewright.plans.queries import QUERIES, SQL
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables to query")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    _, rows, problem = compare(spark, duck, contract.queries()[name], contract.oracle_sql().get(name), SF_DIR)
    assert problem is None
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["status", "n", "total"]


def test_relocated_partitions_with_a_file_of_a_header_alone(spark, tmp_path):
    """The first task finds no order of the partition elsewhere, and leaves a file without rows there."""
    for status, n in (("F", 2000), ("O", 10)):
        orders = spark.range(n).selectExpr("id AS o_orderkey", f"'{status}' AS o_orderstatus").coalesce(1)
        orders.write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    (row,) = QUERIES["inventory_relocated_partitions"](spark, str(tmp_path)).collect()
    assert (row.partitions, row.every_file, row.n) == (2, True, 2010)
