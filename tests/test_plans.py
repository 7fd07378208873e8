"""What the physical plans must and must not hold."""

import functools
import pathlib
import re

import pytest

from linewright.plans import catalog

FOLDER = "/root/testdata/sf0.001"
LAZY = sorted(n for n in catalog.QUERIES if not n.startswith("stream_") and n != "grid_search")


@functools.cache
def plan(spark, name):
    return catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups"):
        assert operator not in text, operator


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "scan_filter_project")
    assert "GreaterThanOrEqual(l_quantity,25.0)" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_comment" not in read and "l_extendedprice" not in read


def test_window_feature_rows_join_once(spark):
    """Four window tables, one equi-join of the rows on (key, cell)."""
    text = plan(spark, "asof_windows")
    assert len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", text)) <= 2


def test_window_order_always_has_a_partition_or_few_rows(spark):
    """An unpartitioned window may only run over rows that an aggregate has bounded."""
    allowed = {"auc_exact", "pr_curve", "roc_curve", "threshold_sweep", "best_threshold", "boosted_metrics"}
    allowed |= {"category_index", "one_hot"}  # one row per sorted part
    for name in LAZY:
        for match in re.finditer(r"windowspecdefinition\(([^\n]*)", plan(spark, name)):
            first = match.group(1).split(",")[0].strip()
            if re.search(r" (ASC|DESC) NULLS", first):
                assert name in allowed, name


def test_library_never_uses_what_breaks_on_lost_executors():
    root = pathlib.Path(__file__).parent.parent / "linewright"
    for path in root.rglob("*.py"):
        text = path.read_text()
        for word in ("localCheckpoint", "crossJoin", ".toPandas(", ".rdd"):
            assert word not in text, (path, word)
