from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from incidara.models import folds, forecast
from incidara.session import stage


@pytest.fixture(scope="module")
def table(spark):
    panel = spark.range(300).select(
        F.lit("a").alias("city"),
        F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("date"),
        (1 + F.pmod(F.xxhash64("id"), F.lit(30)) + F.col("id") % 7).alias("accident_count"),
        *[F.lit(1.0).alias(name) for name in ("temp", "humidity", "visibility", "precip", "sever")],
    )
    return stage(forecast.feature_table(panel), "features")


def test_spans_follow_each_other():
    spans = folds.rolling_folds(date(2020, 1, 30), 3, 3)
    assert [(f.start.day, f.end.day) for f in spans] == [(30, 2), (2, 5), (5, 8)]
    with pytest.raises(ValueError):
        folds.rolling_folds(date(2020, 1, 1), 0, 2)


def test_a_row_is_validated_once_and_never_trained_on_later_days(spark, table):
    spans = folds.rolling_folds(date(2020, 8, 1), 20, 3)
    rows = {r.date: r.fold for r in table.select("date", folds.fold_of(spans).alias("fold")).collect()}
    for day, number in rows.items():
        assert number == next((f.number for f in spans if f.start <= day < f.end), None)
    for row, fold in zip(folds.fold_sizes(table, spans).orderBy("fold").collect(), spans):
        assert row.train_rows == sum(day < fold.start for day in rows) and row.valid_rows == 20
        assert row.last_train_day < fold.start
    assert folds.fold_sizes(table.limit(0), spans).filter("train_rows + valid_rows > 0").isEmpty()


def test_each_fold_is_a_search_of_its_own(table):
    spans = folds.rolling_folds(date(2020, 8, 1), 30, 2)
    found = folds.cross_validate(table, spans, (1, 2), (1, 3), (0.3,))
    for fold in spans:
        train = table.filter(F.col("date") < F.lit(fold.start))
        valid = table.filter((F.col("date") >= F.lit(fold.start)) & (F.col("date") < F.lit(fold.end)))
        alone = forecast.search_forecast(train, valid, (1, 2), (1, 3), (0.3,))
        assert [r["rmse"] for r in found.fold_rows if r["fold"] == fold.number] == pytest.approx([r["rmse"] for r in alone.rows])
    means = [(a["rmse"] + b["rmse"]) / 2 for a, b in zip(found.fold_rows[::2], found.fold_rows[1::2])]
    assert [r["mean_rmse"] for r in found.rows] == pytest.approx(means)
    assert found.best["mean_rmse"] == min(r["mean_rmse"] for r in found.rows)


def test_a_fold_without_rows_raises(table):
    with pytest.raises(ValueError, match="fold 1"):
        folds.cross_validate(table, folds.rolling_folds(date(2020, 10, 1), 60, 2), (1,), (1,), (0.3,))
