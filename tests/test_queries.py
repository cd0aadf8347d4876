"""Every registered query against its SQL, and its plan against the house rules."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, rows as sorted_rows
from millrace.bindings import REGISTRY

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas"]


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(queries()) and set(REGISTRY) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
