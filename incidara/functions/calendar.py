"""Calendar and duration expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

# Weekend days (Sunday=1, Saturday=7) and the 12-hour bound in minutes.
WEEKEND_DAYS = (1, 7)
DAY_MINUTES_BOUND = 12 * 60


def weekend_flag(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def with_calendar(df: DataFrame, day: str = "date") -> DataFrame:
    """Add day_of_week, month, is_weekend and quarter of ``day``."""
    weekday = F.dayofweek(day)
    return df.withColumns(
        {
            "day_of_week": weekday,
            "month": F.month(day),
            "is_weekend": weekend_flag(weekday),
            "quarter": F.quarter(day),
        }
    )


def duration_minutes(start: str, end: str) -> Column:
    """Minutes between two timestamps, counted in whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def iso_week_dates(year: int, week: int) -> list[tuple[date, date]]:
    """Date ranges with calendar year ``year`` and ISO week ``week``.

    The year is the calendar year, so an edge week can have two ranges:
    week 52 of 2022 holds 1-2 January and 26-31 December.
    """
    first, last = date(year, 1, 1), date(year, 12, 31)
    ranges = []
    for iso_year in (year - 1, year, year + 1):
        try:
            monday = date.fromisocalendar(iso_year, week, 1)
        except ValueError:  # this ISO year has no week 53
            continue
        start, end = max(monday, first), min(monday + timedelta(days=6), last)
        if start <= end:
            ranges.append((start, end))
    return ranges
