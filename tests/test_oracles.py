"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from fleetlake.plans import oracles
from fleetlake.plans.queries import REGISTERED

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(REGISTERED))
def test_query_equals_sql(spark, connection, name):
    frame = REGISTERED[name](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    for operator in ("PythonUDF", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    assert check.compare(connection, frame, oracles.ORACLES.get(name)) is None


def test_entry_gives_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_all_queries_have_sql():
    assert set(REGISTERED) == set(oracles.ORACLES)
    assert set(REGISTERED) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
