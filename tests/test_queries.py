"""Every registered query against its SQL, and the shape of every plan, on the smallest tables."""

import os

import pytest

from gaugeworks.plans import load_all
from tests.oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert df.count() >= 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
