"""Every registered query against its oracle, and the shape of its plan."""

import os

import pytest
from compare import differences, oracle

import __spark_entry__ as contract
from swaplens.checks import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert differences(df, con, ORACLES[name]) == []


def test_contract(spark):
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys() and contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).count() > 0
