"""Every registered query against its SQL at the smallest scale; none plans a cross join."""

import pytest

from pagemill.suite import ORACLES, QUERIES
from tools import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = QUERIES[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    verdict, _ = check.compare(spark, connection, name, SF, result)
    assert verdict.startswith("ok") if name in ORACLES else verdict.startswith("rows")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
