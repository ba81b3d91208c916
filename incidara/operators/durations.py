"""Incident durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from incidara.functions import DAY_MINUTES_BOUND, duration_minutes, parse_double, parse_timestamp
from incidara.operators.quality import drop_nulls

# Columns of the modelling table.
MODEL_COLUMNS = ["hour", "severity", "state", "distance", "duration_minutes"]


def with_duration(incidents: DataFrame) -> DataFrame:
    return incidents.withColumn("duration_minutes", duration_minutes("start_time", "end_time"))


def duration_between(
    incidents: DataFrame, low: float = 0, high: float = DAY_MINUTES_BOUND
) -> DataFrame:
    """Durations strictly between the bounds; missing ones are dropped."""
    minutes = F.col("duration_minutes")
    return incidents.filter((minutes > low) & (minutes < high))


def parsed_strings(raw: DataFrame) -> DataFrame:
    """Rename and parse an all-string scan: times, hour, distance."""
    return raw.select(
        F.col("ID").alias("id"),
        parse_timestamp("Start_Time").alias("start_time"),
        parse_timestamp("End_Time").alias("end_time"),
        F.col("Severity").alias("severity"),
        F.col("State").alias("state"),
        parse_double(F.col("`Distance(mi)`")).alias("distance"),
    )


def duration_model_table(incidents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Hour, severity, state, distance and duration, complete rows only.

    ``carry`` keeps further columns (a row key for the split) unchecked.
    """
    timed = duration_between(with_duration(incidents)).withColumn("hour", F.hour("start_time"))
    return drop_nulls(timed.select(*carry, *MODEL_COLUMNS), MODEL_COLUMNS)


def _mean(value: str, weight: str | None) -> Column:
    if weight is None:
        return F.avg(value)
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))


def mean_duration_by_hour(
    scored: DataFrame,
    actual: str = "duration_minutes",
    predicted: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """Actual and predicted mean duration per hour of day.

    ``weight`` names a row count, for rows that are means already.
    """
    return (
        scored.groupBy("hour")
        .agg(
            _mean(actual, weight).alias("actual_avg_duration"),
            _mean(predicted, weight).alias("predicted_avg_duration"),
        )
        .orderBy("hour")
    )


def state_mean_by_hour(rows: DataFrame) -> DataFrame:
    """The same against a naive predictor, the mean duration of the state.

    Rows fold to one per hour and state first; the state means and the join
    work on that table of 24 x states.
    """
    cells = rows.groupBy("hour", "state").agg(
        F.avg("duration_minutes").alias("duration_minutes"), F.count("*").alias("rows")
    )
    naive = cells.groupBy("state").agg(_mean("duration_minutes", "rows").alias("prediction"))
    return mean_duration_by_hour(cells.join(naive, "state"), weight="rows")
