"""Plans stay the ones we want: no pair-building joins, pruned scans, bounded windows."""

import pytest

from tickerloom.plans import ORACLES, QUERIES, ROWS
from tickerloom.plans import views as V

SIMPLE = [
    "margin_pressure", "moving_averages", "net_buy_streaks", "price_report_asof", "trailing_eps_reconcile", "trust_holding",
    "asof_forward_valid_open", "strategy_cohort", "revenue_features", "price_spikes", "completeness", "load_if_absent",
    "high_water_append", "presence_grid", "model_for_target", "entry_days", "daily_quote_report", "statement_facts",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SIMPLE)
def test_no_pair_building_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_what_they_need(spark, sf):
    text = plan(V.quotes(spark, sf).groupBy("date").sum("volume"))
    assert "l_comment" not in text and "l_returnflag" not in text and "l_partkey" not in text
    text = plan(V.calendar(spark, sf))
    assert "ReadSchema: struct<l_shipdate:" in text


def test_quotes_aggregate_by_hash_with_a_partial_step(spark, sf):
    text = plan(V.quotes(spark, sf))
    assert "HashAggregate" in text and "partial_" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["day_range_scan", "symbol_scan", "technical_window_override"])
def test_day_ranges_reach_the_scan(spark, sf, name):
    text = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert all("LessThan(l_shipdate" in line for line in text.split("\n") if "PushedFilters" in line and "l_shipdate" in line)


@pytest.mark.parametrize("name", ["margin_pressure", "short_interest", "trust_holding"])
def test_raw_rows_are_never_sorted_to_be_summed(spark, sf, name):
    lines = plan(QUERIES[name](spark, sf)).split("\n")
    below = [i for i, line in enumerate(lines) if "SortAggregate" in line]
    assert all(any("HashAggregate" in line for line in lines[i + 1 :]) for i in below)
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "l_suppkey" in line]
    for i in scans:  # the first aggregate above each scan of raw rows
        first = next(line for line in reversed(lines[:i]) if "Aggregate(" in line)
        assert "HashAggregate" in first


def test_streak_windows_share_one_sort(spark, sf):
    text = plan(QUERIES["net_buy_streaks"](spark, sf))
    assert text.count("Window [") == 2 and text.count("Sort [symbol#") == 1
    assert text.count("Exchange hashpartitioning(symbol#") == 1


def test_technical_indicators_take_all_windows_over_one_exchange(spark, sf):
    text = plan(QUERIES["technical_indicators"](spark, sf))
    assert text.count("Exchange hashpartitioning(symbol#") == 1
    assert text.count("Window [") == 2 and "decimal" not in text


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES) == set(ROWS)
    assert all(ROWS.values())
