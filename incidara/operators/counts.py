"""Incident counts by hour and severity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from incidara.functions import parse_int

# Severity levels reported.
SEVERITY_LEVELS = (1, 2, 3, 4)


def with_hours(incidents: DataFrame, start: str = "start_time") -> DataFrame:
    return incidents.withColumn("hours", F.hour(start))


def hour_severity_counts(incidents: DataFrame) -> DataFrame:
    """Rows per hour of day and severity. Folds in the tasks to 24 x levels."""
    return incidents.groupBy("hours", "severity").agg(F.count("*").alias("accident_count"))


def hour_counts(by_severity: DataFrame) -> DataFrame:
    """Rows per hour of day, summed from the counts per severity."""
    return by_severity.groupBy("hours").agg(F.sum("accident_count").alias("accident_count"))


def severity_slice(by_severity: DataFrame, level: int) -> DataFrame:
    """Counts per hour for one severity; a non-numeric severity never matches."""
    return (
        by_severity.filter(parse_int("severity") == level)
        .select("hours", "accident_count")
        .orderBy("hours")
    )


def severity_levels(by_severity: DataFrame) -> DataFrame:
    """All reported levels in one table, instead of one job per level."""
    level = parse_int("severity")
    return (
        by_severity.filter(level.isin(*SEVERITY_LEVELS))
        .select("hours", level.alias("level"), "accident_count")
        .orderBy("level", "hours")
    )
