from __future__ import annotations

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from incidara.schema import HOURLY_RESULT_NAMES, INCIDENTS, with_incident_names, with_result_names
from incidara.session import fresh_path, shared_dir
from incidara.sinks import land_by_year, write_csv, write_lines, write_result_csv, write_table
from incidara.sources import (
    cluster_by_id,
    read_cluster_profile,
    read_importances,
    read_incidents,
    read_inferred,
    read_landed,
    read_strings,
    read_typed,
)

CSV = """ID,Source,Severity,Start_Time,End_Time,Distance(mi),City,State,Temperature(F),Humidity(%),Visibility(mi),Precipitation(in),Weather_Condition
A-1,S1,3,2019-04-03 05:30:00,2019-04-03 11:00:00.000000000,0.25,Dover,DE,41.5,88.0,9.0,0.03,Rain
A-2,S1,2,2019-04-03 07:10:09,bad,x1,Reno,NV,,77.0,9.0,0.0,Rain
A-3,,2,2020-04-03 08:20:27,2020-04-03 08:50:27,0.0,Reno,NV,40.0,77.0,9.0,0.0,Clear
"""


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "incidents.csv"
    path.write_text(CSV)
    return str(path)


def test_incidents_by_name_and_lenient(spark, csv_file):
    got = read_incidents(spark, csv_file)
    assert set(got.columns) == set(INCIDENTS.fieldNames())
    kinds = {f.name: f.dataType for f in got.schema}
    assert kinds == {f.name: f.dataType for f in INCIDENTS}
    rows = {r.id: r for r in got.collect()}
    assert rows["A-1"].end_time == datetime(2019, 4, 3, 11) and rows["A-1"].severity == 3
    assert rows["A-2"].end_time is None and rows["A-2"].distance_mi is None
    assert "Precipitation(in)" in with_incident_names(got).columns


def test_any_null_drop_looks_at_unused_columns(spark, csv_file):
    got = read_incidents(spark, csv_file, any_null_drop=True)
    assert [r.id for r in got.collect()] == ["A-1"]  # A-3 only lacks the unused Source


def test_headerless_needs_names(spark, tmp_path, csv_file):
    names = CSV.splitlines()[0].split(",")
    bare = tmp_path / "bare.csv"
    bare.write_text("\n".join(CSV.splitlines()[1:]))
    assert read_strings(spark, str(bare), names).count() == 3
    with_header, without = read_incidents(spark, csv_file), read_incidents(spark, str(bare), names)
    assert without.exceptAll(with_header).isEmpty()


def test_inferred_types(spark, csv_file):
    kinds = dict(read_inferred(spark, csv_file).dtypes)
    assert kinds["Severity"] == "int" and kinds["Start_Time"] == "timestamp"
    assert kinds["Humidity(%)"] == "double" and kinds["Distance(mi)"] == "string"


def test_csv_write_fails_if_there(spark, csv_file):
    path = fresh_path(spark, "csv")
    rows = read_inferred(spark, csv_file)
    write_csv(rows, path)
    with pytest.raises(Exception, match="(?i)exists"):
        write_csv(rows, path)
    assert read_typed(spark, path, rows.schema).exceptAll(rows).isEmpty()


def test_landed_table_prunes_years(spark, csv_file):
    path = fresh_path(spark, "landed")
    land_by_year(read_incidents(spark, csv_file), path)
    year = read_landed(spark, path, date(2020, 1, 1), date(2020, 12, 31))
    assert [r.id for r in year.collect()] == ["A-3"]
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "start_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(start_time" in plan.split("PushedFilters: [")[1]


def test_result_csv_is_one_sorted_file(spark, tmp_path):
    rows = spark.range(24).select((F.lit(23) - F.col("id")).alias("hours"), F.lit(1).alias("accident_count"))
    path = tmp_path / "hours"
    write_result_csv(with_result_names(rows, HOURLY_RESULT_NAMES), str(path), ["Hours"])
    files = list(path.glob("part-*.csv"))
    lines = files[0].read_text().splitlines()
    assert len(files) == 1 and lines[0] == "Hours,Accident Count" and lines[1:3] == ["0,1", "1,1"]


def test_lines_keep_their_order(spark, tmp_path):
    lines = [f"line {n}" for n in range(200)]
    write_lines(spark, lines, str(tmp_path / "log"))
    (file,) = (tmp_path / "log").glob("part-*")
    assert file.read_text().splitlines() == lines


def test_artifacts(spark, tmp_path):
    profile = tmp_path / "profile.csv"
    profile.write_text(
        "Cluster,Mean Temperature (F),Mean Humidity (%),Mean Severity,Mean Visibility (mi),Mean Precipitation (in)\n"
        "0,40.5,61.0,1.5,7.5,0.02\n1,66.0,48.0,3.0,9.0,0.0\n"
    )
    table = read_cluster_profile(spark, str(profile))
    assert [tuple(r) for r in cluster_by_id(table, 1).collect()] == [(1, 66.0, 48.0, 3.0, 9.0, 0.0)]
    scores = tmp_path / "scores.csv"
    scores.write_text("Feature,Importance\nlag_1,0.25\nsever,0.75\n")
    assert [tuple(r) for r in read_importances(spark, str(scores)).collect()] == [("lag_1", 0.25), ("sever", 0.75)]


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    table = spark.range(3)
    path = fresh_path(spark, "t")
    write_table(table, path)
    assert path.startswith(shared_dir(spark))
    assert spark.read.parquet(path).count() == 3


def test_cluster_without_shared_folder_is_refused():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)
