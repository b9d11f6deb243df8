"""Plan properties: the physical plans we want at scale."""

import pytest

from tests.conftest import SF_SMALL
from tidemark.plans.catalog import QUERIES, Model
from tidemark.plans.inspect import count_nodes, explain_string, has_python

Q = QUERIES


@pytest.mark.parametrize("key", sorted(Q))
def test_no_python_in_any_plan(spark, key):
    assert not has_python(explain_string(Q[key](spark, SF_SMALL)))


def test_top_n_uses_window_group_limit(spark):
    plan = explain_string(Q["top_repos"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan and "Final" in plan


def test_dedup_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in explain_string(Q["dedup_snapshots"](spark, SF_SMALL))


def test_breakouts_median_reuses_ranking_shuffle(spark):
    """Ranking + median + filter add exactly one Exchange on top of the binding."""
    m = Model.parts(spark, SF_SMALL)
    used = m.stg.select("repo_id", "repo_name", "language", "stars", "forks", "repo_age_days", "snapshot_date", "url")
    base = count_nodes(explain_string(used), "Exchange")
    plan = explain_string(m.breakouts)
    assert count_nodes(plan, "Exchange") == base + 1
    assert "percentile" in plan  # exact, never approximate
    assert "approx" not in plan.lower()


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = explain_string(Q["breakouts"](spark, SF_SMALL))
    # lineitem: only the 3 columns the breakouts need are read
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(l_partkey)]" in plan


def test_partitioned_mart_prunes_dates(spark, tmp_path):
    from tidemark.operators import metrics
    from tidemark.sources.sinks import read_table, replace_table

    m = Model.parts(spark, SF_SMALL)
    path = str(tmp_path / "trends")
    replace_table(m.trends, path)
    trends = read_table(spark, path)
    plan = explain_string(metrics.select_slice(trends, "1998-06-30", ["brand#1"]))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "1998-06-30" in plan


def test_growth_lags_share_one_window(spark):
    plan = explain_string(Q["language_growth"](spark, SF_SMALL))
    # both lags in one Window node (the binding's first-ship window is pruned: age is unused)
    assert count_nodes(plan.split("\n\n")[0], "Window") == 1


@pytest.mark.parametrize("key", ["explorer_default", "top_for_language"])
def test_date_filter_passes_below_the_aggregate(spark, key):
    """The wanted quarter is selected on lineitem itself, before anything is grouped."""
    plan = Q[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    quarter = next(line for line in plan.splitlines() if "Filter" in line and "last_day" in line)
    assert "1998-06-30" in quarter and plan.index(quarter) > plan.index("Aggregate")


def test_global_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in explain_string(Q["breakouts_top10"](spark, SF_SMALL))


@pytest.mark.parametrize("key", sorted(Q))
def test_no_cross_join_in_any_plan(spark, key):
    plan = explain_string(Q[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
