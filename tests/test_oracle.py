"""Every query with oracle SQL gives the oracle's rows; the others give rows with a stable schema."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import connect, difference

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


# None of these may appear in a plan: Python workers and joins that pair every row with every row.
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_oracle(spark, oracle, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    assert difference(df, oracle, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_oracle(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
