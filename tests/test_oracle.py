"""Every registered query against its SQL on the same files."""

import oracle
import pytest

import __spark_entry__ as contract
from shopgrain import registry

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, folder, connection, name):
    df = QUERIES[name](spark, folder)
    assert oracle.differences(df, connection, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert slow not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
