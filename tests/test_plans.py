"""Plan shape of every registered query: no cross joins, pruned scans."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

SKIP = {"train_models", "train_linear"}  # Spark ML fits run while the plan is built


def _plan_text(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - SKIP))
def test_no_cross_join_and_pruned_scans(spark, key):
    plan = _plan_text(entry.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # no bin search is pushed into a filter on raw rows
    assert "isnotnull(CASE" not in plan and "isnotnull(size" not in plan
    # scans read only the columns the query uses
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    for unused in ("user_id", "event_type", "l_returnflag", "o_custkey"):
        assert all(unused not in s for s in schemas), (unused, schemas)
