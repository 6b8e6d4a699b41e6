"""Every registered query against its reference SQL on the smallest tables."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from compare import connect, mismatch

from authlane.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_registry_is_complete():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert costly not in plan
    assert mismatch(df, duck, ORACLES[name]) is None
