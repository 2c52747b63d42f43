"""Plan properties the design relies on, checked with explain output."""

import re

from larder.catalog.queries import QUERIES
from larder.sources import driver_tables as dt
from tests.conftest import SF_SMOKE


def _plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_line_items_are_never_the_broadcast_build_side(spark):
    plan = _plan(dt.line_facts(spark, SF_SMOKE), "sparkPlan")
    for line in plan.split("\n"):
        if "BroadcastHashJoin" in line and ("l_suppkey" in line or "l_partkey" in line):
            assert "BuildRight" in line, line


def test_fixed_dimensions_broadcast(spark):
    plan = _plan(dt.line_facts(spark, SF_SMOKE), "sparkPlan")
    assert re.search(r"BroadcastHashJoin \[s_nationkey", plan)


def test_feature_stage_is_partitioned_by_series(spark):
    """The long table is never dealt out or windowed by item alone; only the
    item mean's partial sums are."""
    plan = _plan(QUERIES["feature_matrix"](spark, SF_SMOKE))
    assert re.search(r"Exchange hashpartitioning\(store_id#\d+, item_id#\d+, \d+\), REPARTITION_BY_COL", plan)
    assert not re.search(r"Exchange hashpartitioning\(item_id#\d+, \d+\), REPARTITION_BY_COL", plan)
    assert not re.search(r"windowspecdefinition\(item_id#\d+, specified", plan)


def test_one_pass_over_line_items(spark):
    """Every derived table reads the checkpointed daily facts, so the query
    plan itself holds no line-item scan."""
    for name in ("feature_matrix", "replay_ledger", "allocate_ordered", "stock_position"):
        assert "lineitem.parquet" not in _plan(QUERIES[name](spark, SF_SMOKE)), name


def test_allocation_window_per_item(spark):
    plan = _plan(QUERIES["allocate_ordered"](spark, SF_SMOKE))
    assert re.search(r"Window \[.*windowspecdefinition\(item_id#\d+, store_id#\d+ ASC", plan)
