"""Plan shape of every registered query: JVM-only, no cross joins, pruned scans."""

from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as contract
from tests.conftest import SF_SMALL

QUERIES = contract.queries()
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_jvm_only_without_cross_joins(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    # every parquet scan reads a pruned schema, never a table's full width by accident
    assert "ReadSchema" in plan


def test_no_driver_collection_in_operators():
    root = pathlib.Path(__file__).resolve().parents[1] / "parcelle"
    for path in root.rglob("*.py"):
        if path.parent.name == "llm":  # has tests of its own
            continue
        text = path.read_text()
        for call in (".collect()", ".toPandas()", "localCheckpoint"):
            assert call not in text, f"{call} in {path}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_single_task_stages_only_merge_partial_aggregates(spark, name):
    """No query funnels rows into one task: an exchange to a single partition
    is only allowed directly above a partial aggregate (one row per map task),
    as for a global min/max or a correlation."""
    lines = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            assert "Aggregate" in child and "partial_" in child, f"{name}: {line.strip()} over {child.strip()}"
