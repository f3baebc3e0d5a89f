"""Plan checks over every registered batch query."""

import re

import pytest

from tests.conftest import SF001
from veridq.plans.queries import all_queries

SIDE_EFFECT = ("stream_", "pipeline_", "manifest", "ext_rescan", "ext_gate")
QUERIES = {k: v for k, v in all_queries().items() if not k.startswith(SIDE_EFFECT)}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cartesian_no_global_window(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    # a window spec whose first element is a sort order has no partition key; the
    # only allowed one runs over per-bucket counts (one row per 2^20 input rows)
    for m in re.finditer(r"windowspecdefinition\(([^,()]+) (ASC|DESC) NULLS", plan):
        assert m.group(1).startswith("_b#"), f"{name}: unpartitioned window over data"


def test_clean_has_one_exchange_and_group_limit(spark):
    plan = _plan(QUERIES["clean_full"](spark, SF001))
    assert plan.count("Exchange") == 1, plan
    assert "WindowGroupLimit" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(QUERIES["validate_all_failures"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
