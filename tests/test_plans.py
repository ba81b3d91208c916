"""The physical plans that the design relies on."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from incidara.catalog.fixtures import incidents_daily, table
from incidara.catalog.oracle import ORACLE
from incidara.catalog.queries import QUERIES
from incidara.operators.panel import city_day_join, city_day_panel, lag_features, top_cities
from incidara.operators.quality import drop_nulls

SF = "/root/testdata/sf0.001"

# Eager queries (they fit or write first) are run elsewhere.
EAGER = {
    "duration_tree_means", "gbt_means", "model_roundtrip", "csv_roundtrip", "csv_strings",
    "csv_headerless", "csv_inferred", "landed_days", "hour_result_csv",
    "hour_tree_means", "hour_tree_exact", "cluster_nearest", "cluster_profile_total", "clean_chain",
}
LAZY = sorted(set(ORACLE) - EAGER)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_single_task_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert forbidden not in plan
    for window in re.findall(r"Window \[.*", plan):
        assert not window.rstrip().endswith("], [], []")
        assert "windowspecdefinition(specifiedwindowframe" not in window


def test_panel_reads_and_shuffles_once(spark):
    events = table(spark, SF, "events").select(
        F.col("event_id").alias("id"),
        F.to_date("ts").alias("date"),
        F.col("user_id").alias("city"),
        F.col("value").alias("temperature_f"),
        F.col("value").alias("humidity_pct"),
        F.col("value").alias("visibility_mi"),
        F.col("value").alias("precipitation_in"),
        F.length("event_type").alias("severity"),
    )
    plan = plan_of(city_day_panel(events))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "props" not in plan
    joined = plan_of(city_day_join(events))
    assert joined.count("FileScan") == 2 and joined.count("Exchange hashpartitioning") >= 2
    lagged = plan_of(lag_features(city_day_panel(events)))
    assert lagged.count("FileScan") == 1 and lagged.count("Exchange hashpartitioning") == 2
    assert lagged.count("Window [") == 1


def test_null_drop_reaches_the_scan(spark):
    events = table(spark, SF, "events")
    ours = plan_of(drop_nulls(events, ["value", "user_id"]).select("value"))
    assert "IsNotNull(value)" in ours and "IsNotNull(user_id)" in ours
    assert "props" not in ours.split("ReadSchema")[1]
    assert "PushedFilters: []" in plan_of(events.na.drop(subset=["value", "user_id"]))


def test_top_cities_has_no_global_sort(spark):
    plan = plan_of(top_cities(incidents_daily(spark, SF)))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_week_reaches_the_scan(spark):
    plan = plan_of(QUERIES["week_slice"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1998-03-02" in plan


def test_date_filter_stays_above_the_lag(spark):
    lagged = lag_features(city_day_panel(incidents_daily(spark, SF)))
    plan = plan_of(lagged.filter(F.col("date") >= F.lit(date(2001, 1, 1))))
    assert "GreaterThanOrEqual(o_orderdate" not in plan


def test_columns_are_pruned(spark):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES["hour_counts"](spark, SF)))
    assert schemas == ["ts:timestamp_ntz"] or schemas == ["ts:timestamp_ntz,event_type:string"]
