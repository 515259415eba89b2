"""Every registered query against DuckDB, and what must hold of all their plans."""

import os

import pytest

import __spark_entry__ as contract
import compare

SF_DIR = os.environ.get("ORDERFLOW_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan
    assert compare.differences(df, con, ORACLES[name]) == []


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:6] == ["order_year", "order_month", "order_quarter", "product_category", "region", "channel"]
    assert df.count() == 47
