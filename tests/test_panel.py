from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from incidara.catalog.fixtures import with_end_time
from incidara.functions import exact_sum
from incidara.operators.counts import hour_counts, hour_severity_counts, severity_levels, severity_slice
from incidara.operators.durations import duration_between, parsed_strings
from incidara.operators.panel import (
    city_day_join,
    city_day_panel,
    city_profile,
    lag_features,
    top_cities,
    with_date,
)
from incidara.operators.series import top_city_series, week_slice

COLUMNS = (
    "id string, start_time timestamp, severity int, city string, state string, "
    "temperature_f double, humidity_pct double, visibility_mi double, precipitation_in double"
)


@pytest.fixture(scope="module")
def incidents(spark):
    def row(n, day, city, state, temp):
        when = None if day is None else datetime(2022, 3, day, 5)
        return (f"A{n}", when, 1 + n % 4, city, state, temp, 50.0, 10.0, None)

    rows = [
        row(1, 7, "Dover", "DE", 40.0),
        row(2, 7, "Dover", "NH", 50.0),
        row(3, 8, "Dover", "DE", None),
        row(4, 8, "Reno", "NV", 70.25),
        row(5, None, "Reno", "NV", 10.0),
        row(6, 9, None, "NV", 10.0),
    ]
    return with_date(spark.createDataFrame(rows, COLUMNS))


def test_panel_keeps_observed_days_only(incidents):
    got = {(r.city, r.date.day): (r.accident_count, r.temp, r.precip) for r in city_day_panel(incidents).collect()}
    assert got == {
        ("Dover", 7): (2, 45.0, None),
        ("Dover", 8): (1, None, None),
        ("Reno", 8): (1, 70.25, None),
    }


@pytest.mark.parametrize("scale", [None, 4])
def test_join_form_equals_panel(incidents, scale):
    one, two = city_day_panel(incidents, exact_scale=scale), city_day_join(incidents, exact_scale=scale)
    assert one.columns == two.columns
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_state_can_join_the_key(incidents):
    assert city_day_panel(incidents, ["state", "city"]).count() == 4


def test_profile_uses_days_without_date(incidents):
    got = {r.city: (r.avg_temp, r.avg_severity) for r in city_profile(incidents).collect()}
    assert got["Reno"] == (40.125, 1.5) and got[None] == (10.0, 3.0)
    assert got["Dover"] == (45.0, 3.0)


def test_top_breaks_ties_by_name(spark):
    rows = spark.createDataFrame([("b", "1"), ("a", "2"), ("c", "3"), ("c", "4")], "city string, id string")
    got = [tuple(r) for r in top_cities(rows, 2).collect()]
    assert got == [("c", 2), ("a", 1)]


def test_lag_steps_over_rows(spark):
    days = [date(2022, 1, 1) + timedelta(days=3 * n) for n in range(9)]
    panel = spark.createDataFrame(
        [("x", d, n) for n, d in enumerate(days)], "city string, date date, accident_count long"
    )
    got = [tuple(r)[1:] for r in lag_features(panel).orderBy("date").collect()]
    assert got == [(days[7], 7, 6, 0), (days[8], 8, 7, 1)]


def test_date_filter_after_lag_keeps_history(spark):
    days = [date(2020, 12, 20) + timedelta(days=n) for n in range(20)]
    panel = spark.createDataFrame(
        [("x", d, n) for n, d in enumerate(days)], "city string, date date, accident_count long"
    )
    late = lag_features(panel).filter(F.col("date") >= F.lit(date(2021, 1, 1))).orderBy("date")
    assert late.first().lag_7 == 5


def test_week_slice_edge(spark):
    days = [date(2022, 1, 1), date(2022, 1, 3), date(2022, 12, 26), date(2021, 12, 31)]
    panel = spark.createDataFrame(
        [("x", d, 1) for d in days], "city string, date date, accident_count long"
    )
    assert [r.date for r in week_slice(panel, 2022, 52).collect()] == [days[0], days[2]]
    assert week_slice(panel, 2022, 53).count() == 0


def test_top_city_series(spark):
    panel = spark.createDataFrame(
        [("a", date(2022, 1, n), n, 9) for n in (1, 2)] + [("b", date(2022, 1, 1), 1, 9)],
        "city string, date date, accident_count long, p int",
    )
    got = [tuple(r) for r in top_city_series(panel, "p", n=1).collect()]
    assert got == [("a", date(2022, 1, 1), 1, 9), ("a", date(2022, 1, 2), 2, 9)]


def test_severity_slices(spark):
    rows = spark.createDataFrame(
        [(1, "2"), (1, "2"), (3, "2"), (1, "4"), (1, "odd")], "hours int, severity string"
    )
    counted = hour_severity_counts(rows)
    assert [tuple(r) for r in severity_slice(counted, 2).collect()] == [(1, 2), (3, 1)]
    assert [tuple(r) for r in severity_levels(counted).collect()] == [(1, 2, 2), (3, 2, 1), (1, 4, 1)]
    assert {tuple(r) for r in hour_counts(counted).collect()} == {(1, 4), (3, 1)}


def test_duration_bounds_are_strict(spark):
    rows = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 719.9, 720.0, None)], "duration_minutes double")
    assert [r[0] for r in duration_between(rows).collect()] == [0.5, 719.9]


def test_parsed_strings(spark):
    rows = spark.createDataFrame(
        [("A", "2022-01-01 10:00:00", "oops", "2", "NV", "1.5x")],
        "ID string, Start_Time string, End_Time string, Severity string, State string, `Distance(mi)` string",
    )
    got = parsed_strings(rows).first()
    assert got.start_time.hour == 10 and got.end_time is None and got.distance is None


def test_end_time_is_the_next_start_of_the_user(spark):
    # One user with most rows, in bursts with empty hours between, and equal times.
    start = datetime(2024, 1, 1)
    rows = [(n, 1, start + timedelta(minutes=(n * 7) % 600 + 60 * (n % 5) * 24)) for n in range(400)]
    rows += [(1000 + n, 2 + n % 9, start + timedelta(minutes=n * 13)) for n in range(100)]
    table = spark.createDataFrame(rows, "id int, user_id int, start_time timestamp")
    got = {r.id: r.end_time for r in with_end_time(table).collect()}
    want = {}
    for user in {u for _, u, _ in rows}:
        own = sorted((t, n) for n, u, t in rows if u == user)
        for (_, n), following in zip(own, [*own[1:], (None, None)]):
            want[n] = following[0]
    assert got == want


def test_exact_sums_survive_large_totals(spark):
    # Ten thousand rows of 10^14 units each would overflow one 64-bit sum at 10^19.
    rows = spark.range(100_000).select(
        F.lit("x").alias("city"),
        F.when(F.col("id") % 2 == 0, 1e11).otherwise(-3e10 - 0.0625).alias("v"),
    )
    total = rows.groupBy("city").agg(exact_sum("v", 4).alias("t")).first().t
    assert total == Decimal(50_000) * (Decimal("1e11") - Decimal("3e10") - Decimal("0.0625"))
