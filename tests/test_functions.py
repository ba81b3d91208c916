from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from incidara.functions import (
    duration_minutes,
    from_log,
    iso_week_dates,
    log_target,
    parse_double,
    parse_int,
    parse_timestamp,
    rounded_count,
    with_calendar,
)


def test_bad_strings_become_null(spark):
    rows = spark.createDataFrame(
        [("2019-06-12 10:10:56.000000000",), ("bad",), ("x1",), (None,), ("7",)], "v string"
    ).select(
        parse_timestamp("v").cast("string").alias("ts"),
        parse_double("v").alias("d"),
        parse_int("v").alias("i"),
    )
    got = [tuple(row) for row in rows.collect()]
    assert got[0] == ("2019-06-12 10:10:56", None, None)
    assert got[1] == got[2] == got[3] == (None, None, None)
    assert got[4][1:] == (7.0, 7)


def test_calendar(spark):
    days = spark.createDataFrame([(date(2022, 1, 1),), (date(2022, 1, 2),), (date(2022, 5, 4),)], "date date")
    got = [tuple(row)[1:] for row in with_calendar(days).orderBy("date").collect()]
    assert got == [(7, 1, 1, 1), (1, 1, 1, 1), (4, 5, 0, 2)]


@pytest.mark.parametrize("year", [1998, 2020, 2021, 2022, 2024])
def test_iso_week_ranges_equal_year_and_week(year):
    for week in range(1, 54):
        days = [date(year, 1, 1) + timedelta(days=n) for n in range(366)]
        want = [d for d in days if d.year == year and d.isocalendar().week == week]
        got = [
            first + timedelta(days=n)
            for first, last in iso_week_dates(year, week)
            for n in range((last - first).days + 1)
        ]
        assert got == want, (year, week)


def test_iso_week_edge():
    assert iso_week_dates(2022, 52)[0] == (date(2022, 1, 1), date(2022, 1, 2))


def test_duration_counts_whole_seconds(spark):
    rows = spark.createDataFrame(
        [("2020-01-01 00:00:00.9", "2020-01-01 00:01:30.1")], "s string, e string"
    ).select(F.to_timestamp("s").alias("s"), F.to_timestamp("e").alias("e"))
    assert rows.select(duration_minutes("s", "e")).first()[0] == 1.5


def test_log_round_trip_and_clamp(spark):
    rows = spark.createDataFrame([(0.0,), (2.5,), (0.4,), (-3.0,), (None,)], "v double")
    got = [
        tuple(row)
        for row in rows.select(
            rounded_count("v").alias("n"), F.round(from_log(log_target("v")), 9).alias("back")
        ).collect()
    ]
    assert [n for n, _ in got] == [0, 3, 0, 0, None]
    assert [b for _, b in got][:3] == [0.0, 2.5, 0.4]
