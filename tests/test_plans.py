"""Properties every registered query's plan must have."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import TABLES_DIR
from isobar.plans.catalogue import QUERIES

WRITING = {
    "upsert_stored", "bulk_load", "csv_dimension", "stream_ingest", "stream_daily", "table_roundtrip", "document_insert",
    "process_day_stored", "refresh_stored", "stream_hourly", "stream_late_days", "latest_stored", "counter_stored",
    "stream_first_poll", "trend_refresh", "scan_city_stored", "trend_bucketed", "csv_rejects",
}
LAZY = sorted(QUERIES.keys() - WRITING)


def plan(spark, name):
    return contract.queries()[name](spark, TABLES_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "CollectLimit"):
        assert operator not in text


def test_predicates_reach_the_scan(spark):
    assert "EqualTo(event_type,view)" in plan(spark, "scan_project")
    for name in ("range_half_open", "process_day"):
        text = plan(spark, name)
        assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_columns_are_pruned(spark):
    assert "ReadSchema: struct<user_id:bigint>" in plan(spark, "missing_cities")
    assert "props" not in plan(spark, "kelvin")


@pytest.mark.parametrize("name", ["agg_daily", "agg_monthly", "agg_yearly", "daily_stats_window", "process_day"])
def test_one_scan_one_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_avg" in text


def final_plan(spark, name):
    df = contract.queries()[name](spark, TABLES_DIR)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_one_scan(spark):
    text = plan(spark, "upsert_observations")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    text = final_plan(spark, "trend_delta")
    assert text.count("FileScan") == 1 and text.count("ReusedExchange") == 1


def test_grains_share_one_scan(spark):
    text = plan(spark, "agg_all_grains")
    assert text.count("FileScan") == 1
    assert text.index("Expand") < text.index("FileScan") and text.count("HashAggregate") == 4
