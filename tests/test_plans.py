"""Physical-plan checks: no nested-loop or cartesian joins, pruned scans."""

import pytest

from paths import SF_SMALL
from pricelens.plans.registry import load_all

QUERIES = load_all()
SQL_QUERIES = sorted(n for n, q in QUERIES.items() if q.sql)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_no_nested_loop_or_cartesian(spark, name):
    plan = QUERIES[name].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_panel_scan_is_pruned(spark):
    from pricelens.sources.adapter import build_price_panel
    plan = build_price_panel(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # only the five line-item columns the panel needs are read
    assert "l_orderkey" not in plan and "l_comment" not in plan and "l_discount" not in plan
    assert "partial_avg" in plan and "partial_sum" in plan  # map-side combine before the shuffle
