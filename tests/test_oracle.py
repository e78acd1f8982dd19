"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from divtide.plans.oracle import ORACLES
from divtide.plans.registry import QUERIES
from tests.compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    """The same rows, without a join of all pairs and without Python in the plan."""
    result = QUERIES[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapInArrow"):
        assert operator not in plan
    assert assert_same(result, duck, ORACLES[name]) > 0


def test_entry(spark):
    top = entry(spark)
    assert [f.dataType.simpleString() for f in top.schema] == ["string", "int", "double", "double", "double"]
    assert top.count() == 10
