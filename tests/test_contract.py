import os
import re

import pytest

import __spark_entry__ as contract
import bindings
from tools.check_queries import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The optional part's queries have tests of their own.
QUERIES = bindings.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, SF).startswith("ok")


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["papel", "total"]
    assert df.count() > 0


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_ranges_reach_the_scan(spark):
    plan = executed(QUERIES["p05_month_filter"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1996-02-01" in plan


# Streams and jobs end in a scan of what they wrote; their plans are seen by their own tests.
PLANNED = sorted(QUERIES)


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_python_and_no_cross_join(spark, name):
    plan = executed(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert operator not in plan
