"""Whole analyses on a small incident file."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from incidara.__main__ import main
from incidara.operators.splits import TimeBounds
from incidara.plans.cleaning import clean
from incidara.plans.daily import daily_forecast
from incidara.plans.durations import duration_prediction
from incidara.plans.hourly import hourly_counts
from incidara.sources import load_pipeline, read_incidents, read_landed, read_strings, read_table_strings

HEADER = (
    "ID,Severity,Start_Time,End_Time,Distance(mi),City,State,Temperature(F),Humidity(%),"
    "Visibility(mi),Precipitation(in),Weather_Condition"
)


@pytest.fixture(scope="module")
def csv_file(tmp_path_factory):
    lines = [HEADER]
    start = datetime(2020, 1, 1)
    for n in range(4000):
        when = start + timedelta(hours=(n * 5) % (24 * 240), minutes=n % 60)
        end = when + timedelta(minutes=10 + (n * 13) % 300)
        temp = "" if n % 50 == 0 else f"{(n * 7) % 90}.5"
        city = "ABCDEFGH"[min(n * n % 11, 7)]
        lines.append(
            f"A-{n},{1 + n % 4},{when},{end},{n % 9}.25,{city},S{n % 3},{temp},{n % 100}.0,10.0,0.{n % 10},Clear"
        )
    path = tmp_path_factory.mktemp("in") / "incidents.csv"
    path.write_text("\n".join(lines))
    return str(path)


def test_daily_forecast(spark, csv_file, tmp_path):
    incidents = read_incidents(spark, csv_file)
    out = str(tmp_path / "daily")
    search = daily_forecast(
        incidents, out, bounds=TimeBounds(date(2020, 5, 1), date(2020, 7, 1)),
        depths=(2,), iterations=(2, 3), steps=(0.3,), parallelism=2,
    )
    assert len(search.rows) == 2

    def read(name):
        return spark.read.parquet(f"{out}/{name}")

    assert read("top_cities").count() == 6 and read("city_clusters").count() == 6
    assert {r.split for r in read("split_series").select("split").distinct().collect()} == {"train", "valid", "test"}
    assert read("split_bounds").count() == 2 and read("importances").count() == 11
    forecast = read("forecast")
    assert forecast.filter("date < '2020-07-01'").isEmpty() and forecast.count() > 0
    assert read("city_series").select("city").distinct().count() == 5
    model = load_pipeline(f"{out}/model")
    assert model.stages[1].getNumTrees == search.best["max_iter"]
    log = [r.value for r in spark.read.text(f"{out}/tuning_log").collect()]
    assert len(log) == 7 and log[-1].startswith("LOG RMSE on testing data: ")
    total = read("top_cities").agg({"total_accidents": "sum"}).first()[0]
    assert total == 4000 - 80  # rows without a temperature are dropped


def test_command_line_daily_by_state(spark, csv_file, tmp_path):
    out = str(tmp_path / "daily")
    main(
        ["daily", csv_file, out, "--by-state", "--exact-scale", "4", "--depths", "2"]
        + ["--iterations", "2", "--steps", "0.3"]
        + ["--valid-start", "2020-05-01", "--test-start", "2020-07-01"]
    )
    hotspots = spark.read.parquet(f"{out}/top_cities")
    assert hotspots.columns == ["state", "city", "total_accidents"] and hotspots.count() == 18
    tuning = spark.read.parquet(f"{out}/tuning").collect()
    assert len(tuning) == 1 and tuning[0].is_best


def test_hourly_counts(spark, csv_file, tmp_path):
    out = str(tmp_path / "hourly")
    search = hourly_counts(read_strings(spark, csv_file), out)
    assert len(search.rows) == 8
    result = spark.read.csv(f"{out}/hour_result", header=True, inferSchema=True)
    assert result.columns == ["Hours", "Accident Count", "prediction"] and result.count() == 24
    assert result.agg({"Accident Count": "sum"}).first()[0] == 4000 - 80


def test_duration_prediction(spark, csv_file, tmp_path):
    out = str(tmp_path / "duration")
    search = duration_prediction(read_strings(spark, csv_file), out, parallelism=2)
    assert len(search.rows) == 8
    means = spark.read.csv(f"{out}/mean_duration_by_hour", header=True, inferSchema=True)
    assert means.columns == ["hour", "actual_avg_duration", "predicted_avg_duration"]
    assert 0 < means.count() <= 24


@pytest.mark.parametrize("as_csv", [False, True])
def test_clean(spark, csv_file, tmp_path, as_csv):
    incidents = read_incidents(spark, csv_file)
    result = clean(incidents, str(tmp_path / "clean"), as_csv=as_csv)
    counts = {r.column_name: r.non_null for r in result["non_null"].collect()}
    assert counts["id"] == 4000 and counts["temperature_f"] == 4000 - 80
    assert tuple(result["duplicates"].first()) == (4000, 4000)
    assert result["cleaned"].filter("temperature_f is null").isEmpty()
    assert result["cleaned"].columns == incidents.columns


def test_command_line_samples_chunks(spark, csv_file, tmp_path):
    out = str(tmp_path / "sample")
    main(["sample", csv_file, out, "--fraction", "0.1"])
    drawn = spark.read.csv(out, header=True)
    assert drawn.columns == HEADER.split(",") and drawn.count() == 400
    assert drawn.select("ID").distinct().count() == 400


def test_command_line_lands(spark, csv_file, tmp_path):
    out = str(tmp_path / "landed")
    main(["land", csv_file, out])
    assert read_landed(spark, out, date(2020, 2, 1)).count() < 4000
    assert read_landed(spark, out).count() == 4000


def _wide_csv(tmp_path, bad_ends: int = 0) -> tuple[str, int]:
    """A file of 14 columns, in other cases than published; its rows without a missing value."""
    lines = [HEADER.replace("Start_Time", "start_time") + ",Source,Start_Lat"]
    for n in range(2000):
        when = datetime(2020, 1, 1) + timedelta(hours=5 * n)
        end = "bad" if bad_ends and n % bad_ends == 0 else when + timedelta(minutes=10 + n % 300)
        temp = "" if n % 50 == 7 else f"{n % 90}.5"
        lines.append(f"A-{n},{1 + n % 4},{when},{end},{n % 9}.25,{'ABCDE'[n % 5]},S{n % 3},{temp},50.0,10.0,0.1,Clear,x,{n}")
    path = tmp_path / "wide.csv"
    path.write_text("\n".join(lines))
    return str(path), sum(n % 50 != 7 for n in range(2000))


GRID = ["--depths", "2", "--iterations", "2", "--steps", "0.3", "--valid-start", "2020-09-01", "--test-start", "2020-12-01"]


@pytest.mark.parametrize("first", ["clean-csv", "clean", "land", None])
def test_jobs_read_what_jobs_write(spark, tmp_path, first):
    path, complete = _wide_csv(tmp_path, bad_ends=10)
    if first:
        out = str(tmp_path / "one")
        main([first.split("-")[0], path, out, *["--csv"] * first.endswith("csv")])
        path = out if first == "land" else f"{out}/cleaned"
    table = read_table_strings(spark, path)
    assert len(table.columns) == 14 and {"Source", "Start_Lat", "ID", "Start_Time"} <= set(table.columns)
    main(["daily", path, str(tmp_path / "two"), *GRID])
    counted = spark.read.parquet(str(tmp_path / "two" / "top_cities")).agg({"total_accidents": "sum"}).first()[0]
    # rows whose end does not parse count, where the file at hand still holds them as they were
    unread = sum(n % 10 == 0 and (first is None and n % 50 != 7 or first is not None) for n in range(2000))
    want = {None: complete, "clean-csv": 2000 - unread, "clean": 2000 - unread}
    lost = sum(n % 10 == 0 or n % 50 == 7 for n in range(2000))
    assert counted == want.get(first, 2000 - lost)


def test_duration_reads_the_cleaned_table(spark, tmp_path):
    path, _ = _wide_csv(tmp_path)
    main(["clean", path, str(tmp_path / "one")])
    main(["duration", str(tmp_path / "one" / "cleaned"), str(tmp_path / "two"), "--parallelism", "1", "--no-cache"])
    assert spark.read.csv(str(tmp_path / "two" / "mean_duration_by_hour"), header=True).count() > 0


def test_a_missing_column_is_named(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("ID,Start_Time\n1,2020-01-01 00:00:00")
    with pytest.raises(ValueError, match="Severity"):
        main(["hourly", str(path), str(tmp_path / "out")])
