"""Counts per hour and severity, and a tree on the hour of day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from incidara.functions import parse_timestamp
from incidara.models.hourly import score_hours, search_hour_tree
from incidara.models.metrics import tuning_table
from incidara.models.trees import TreeSearch
from incidara.operators.counts import (
    hour_counts,
    hour_severity_counts,
    severity_levels,
    with_hours,
)
from incidara.operators.quality import drop_nulls
from incidara.schema import HOURLY_RESULT_NAMES, with_result_names
from incidara.session import stage
from incidara.sinks import write_result_csv, write_table


def hourly_counts(raw: DataFrame, out: str, any_null_drop: bool = True) -> TreeSearch:
    """Run on an all-string scan (columns Start_Time, Severity) and write under ``out``."""
    spark = raw.sparkSession
    used = ["Start_Time", "Severity"]
    rows = drop_nulls(raw, None if any_null_drop else used).select(
        parse_timestamp("Start_Time").alias("start_time"), F.col("Severity").alias("severity")
    )
    by_severity = stage(hour_severity_counts(with_hours(rows)), "hour-severity")
    write_table(by_severity, f"{out}/hour_severity_counts")
    write_table(severity_levels(by_severity), f"{out}/severity_levels")

    counts = stage(hour_counts(by_severity), "hours")
    search = search_hour_tree(counts)
    write_table(tuning_table(spark, search.rows), f"{out}/tuning")
    result = with_result_names(score_hours(search.model, counts), HOURLY_RESULT_NAMES)
    write_result_csv(result, f"{out}/hour_result", ["Hours"])
    return search
