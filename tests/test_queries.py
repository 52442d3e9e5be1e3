"""Every registered query against its SQL on the small provided tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from jobtide.queries import ALL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="provided tables not here")
QUERIES, SQL = {k: entry.queries()[k] for k in ALL}, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert name in SQL
    assert differences(df, con, SQL[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan
