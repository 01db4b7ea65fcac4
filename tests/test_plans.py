"""Every registered query: no Python evaluation, no cartesian or nested-loop join, no window."""

import pytest

from quayside.queries import QUERIES
from helpers import SF

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct",
             "BroadcastNestedLoopJoin", "Window ")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_plan_is_native(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_attempts_come_from_one_join(spark):
    import __spark_entry__ as e

    plan = e.queries()["tick_actions"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # rows with their ids, files with their ledger
