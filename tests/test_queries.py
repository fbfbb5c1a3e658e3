"""Every registered query against its SQL on the smallest tables."""

import pytest

from compare import connect, difference
from tillroll.plans import load

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
PAIR_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql_without_python_or_pair_joins(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in (*PYTHON_NODES, *PAIR_JOINS) if node in plan]
    assert difference(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
