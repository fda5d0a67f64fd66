"""Plan regressions: no registered query plans a cartesian or nested-loop join,
scans read only what they use, and the spatial join broadcasts its lookups."""

import contextlib
import io
import os
import re

import pytest

from blotter.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_pairwise_joins(spark, name):
    plan = _plan(registry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_locate_broadcasts_polygon_tables(spark):
    plan = _plan(registry.queries()["locate"](spark, SF))
    assert plan.count("BroadcastHashJoin") >= 2


def test_monthly_trend_reads_one_column(spark):
    plan = _plan(registry.queries()["monthly_trend"](spark, SF))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_change_matrices_take_one_aggregation(spark):
    for name in ("change_matrix_wide", "change_matrix_long"):
        plan = _plan(registry.queries()[name](spark, SF))
        assert len(set(re.findall(r"\((\d+)\) Exchange", plan))) <= 2, name
        assert "rangepartitioning" not in plan


def test_category_groups_are_joined_after_counting(spark):
    plan = _plan(registry.queries()["category_group_table"](spark, SF))
    assert len(set(re.findall(r"\((\d+)\) Scan parquet", plan))) <= 2


def test_level_grid_has_no_single_partition_window(spark):
    plan = _plan(registry.queries()["level_trend"](spark, SF))
    assert "SinglePartition" not in plan.split("Subqueries")[0]
