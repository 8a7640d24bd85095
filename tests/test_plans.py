"""Plan guards for every registered query: no cross / nested-loop joins and no
row-at-a-time or Arrow Python evaluation on the batch path."""

import pytest

from fareweave.plans.registry import QUERIES, load_all

from .conftest import SF_SMALL

load_all()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [f for f in FORBIDDEN if f in plan]
    assert not found, f"{key}: {found}"
