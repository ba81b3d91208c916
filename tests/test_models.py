from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from incidara.models import clusters, duration, forecast, hourly
from incidara.models.metrics import first_best, rmse, rmse_each, rmse_of
from incidara.operators.splits import TimeBounds, split_by_time
from incidara.session import fresh_path, stage
from incidara.sinks import save_pipeline
from incidara.sources import load_pipeline

BOUNDS = TimeBounds(date(2021, 1, 1), date(2021, 4, 1))


@pytest.fixture(scope="module")
def parts(spark):
    start = date(2020, 1, 1)
    panel = (
        spark.range(500)
        .withColumn("city", F.explode(F.split(F.lit("a b c"), " ")))
        .select(
            "city",
            F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"),
            (1 + F.pmod(F.xxhash64("city", "id"), F.lit(30)) + F.col("id") % 7).alias("accident_count"),
            (F.pmod(F.xxhash64("id"), F.lit(70)) * 1.0).alias("temp"),
            (F.pmod(F.xxhash64("id", "city"), F.lit(90)) * 1.0).alias("humidity"),
            F.lit(10.0).alias("visibility"),
            F.lit(0.0).alias("precip"),
            (F.col("id") % 4 + 1.0).alias("sever"),
        )
    )
    return split_by_time(stage(forecast.feature_table(panel), "features"), BOUNDS)


def test_prefix_error_equals_shorter_fit(parts):
    train, valid, _ = parts
    search = forecast.search_forecast(train, valid, (2,), (2, 4), (0.3,))
    short = forecast.fit_forecast(train, 2, 2, 0.3)
    own = RegressionEvaluator(labelCol=forecast.LABEL, metricName="rmse").evaluate(short.transform(valid))
    assert search.rows[0]["rmse"] == pytest.approx(own, rel=1e-12)
    assert search.best["rmse"] == min(row["rmse"] for row in search.rows)
    assert search.model.stages[1].getNumTrees == search.best["max_iter"]
    assert rmse(search.model.transform(valid), forecast.LABEL) == pytest.approx(search.best["rmse"], rel=1e-12)


def test_grid_order_and_parallel_fits(parts):
    train, valid, _ = parts
    one = forecast.search_forecast(train, valid, (1, 2), (1, 2), (0.1, 0.3))
    two = forecast.search_forecast(train, valid, (1, 2), (1, 2), (0.1, 0.3), parallelism=4)
    points = [(r["max_depth"], r["max_iter"], r["step_size"]) for r in one.rows]
    assert points == [(d, n, s) for d in (1, 2) for n in (1, 2) for s in (0.1, 0.3)]
    assert [r["rmse"] for r in one.rows] == pytest.approx([r["rmse"] for r in two.rows], rel=1e-12)
    lines = forecast.search_log(one, 0.5)
    assert lines[0] == "Training with maxDepth=1, maxIter=1, stepSize=0.1"
    assert lines[1] == f"→ RMSE: {one.rows[0]['rmse']}" and len(lines) == 2 * 8 + 3
    assert lines[-1] == "LOG RMSE on testing data: 0.5"


def test_scores_and_importances(spark, parts):
    train, _, test = parts
    model = forecast.fit_forecast(train, 2, 3, 0.3)
    scored = forecast.score_forecast(model, test)
    row = scored.first()
    assert row.predicted_count == pytest.approx(math.expm1(row.prediction))
    assert dict(scored.dtypes)["predicted_count_rounded"] == "int"
    assert scored.filter("predicted_count_rounded < 0").isEmpty()
    table = [tuple(r) for r in forecast.importances(spark, model).collect()]
    assert {name for name, _ in table} == set(forecast.FEATURES)
    assert sum(value for _, value in table) == pytest.approx(1) and all(v >= 0 for _, v in table)
    assert [v for _, v in table] == sorted((v for _, v in table), reverse=True)


def test_features_of_the_past_only(parts):
    train, valid, _ = parts
    search = forecast.search_forecast(train, valid, (2,), (2,), (0.3,), forecast.PAST_FEATURES)
    assert search.model.stages[0].getInputCols() == forecast.PAST_FEATURES
    assert search.model.stages[1].numFeatures == 6


def test_missing_feature_raises(parts):
    train, _, _ = parts
    broken = train.withColumn("temp", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="(?i)null|nan"):
        forecast.fit_forecast(broken, 2, 1, 0.3)


def test_best_is_the_first_least():
    rows = [{"e": float("nan")}, {"e": 2.0}, {"e": 1.0}, {"e": 1.0}]
    assert [r["is_best"] for r in first_best(rows, "e")] == [False, False, True, False]
    with pytest.raises(ValueError, match="empty"):
        first_best([{"e": float("nan")}], "e")


def test_errors_in_one_pass_equal_the_evaluator(parts):
    train, valid, _ = parts
    models = [forecast.fit_forecast(train, 1, n, 0.3) for n in (1, 2)]
    vectors = models[0].stages[0].transform(valid)
    got = rmse_each([m.stages[1] for m in models], vectors, forecast.LABEL)
    assert got == pytest.approx([rmse(m.transform(valid), forecast.LABEL) for m in models], rel=1e-12)


def test_rmse_aggregate(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (2.0, 6.0)], "y double, p double")
    assert rows.agg(rmse_of("y", "p")).first()[0] == pytest.approx(math.sqrt(12.5))


@pytest.fixture(scope="module")
def hours(spark):
    return stage(
        spark.range(24).select(
            F.col("id").cast("int").alias("hours"),
            (F.col("id") * (23 - F.col("id")) * 10 + 5).alias("accident_count"),
        ),
        "hours",
    )


def test_hour_split_ignores_the_layout(hours):
    parts = [
        [sorted(r.hours for r in part.collect()) for part in hourly.split_hours(frame)]
        for frame in (hours, hours.repartition(7), hours.orderBy(F.desc("hours")))
    ]
    assert parts[0] == parts[1] == parts[2]
    assert sorted(parts[0][0] + parts[0][1]) == list(range(24)) and parts[0][1]


def test_hour_tree(hours):
    search = hourly.search_hour_tree(hours)
    assert len(search.rows) == 8 and sum(r["is_best"] for r in search.rows) == 1
    best = next(r for r in search.rows if r["is_best"])
    assert best["valid_rmse"] == min(r["valid_rmse"] for r in search.rows)
    train, _ = hourly.split_hours(hours)
    means = search.model.transform(train).agg(F.avg("accident_count"), F.avg("prediction")).first()
    assert means[0] == pytest.approx(means[1])
    leaves = search.model.transform(train).groupBy("prediction").count().collect()
    assert len(leaves) <= 2 ** best["max_depth"]
    assert min(r["count"] for r in leaves) >= best["min_instances"]
    scored = hourly.score_hours(search.model, hours)
    assert scored.count() == 24 and scored.columns == ["hours", "accident_count", "prediction"]


def test_saved_pipeline_predicts_the_same(spark, hours):
    model = hourly.search_hour_tree(hours, (3,), (2,)).model
    path = fresh_path(spark, "model")
    save_pipeline(model, path)
    save_pipeline(model, path)  # replaces
    again = load_pipeline(path)
    assert hourly.score_hours(again, hours).collect() == hourly.score_hours(model, hours).collect()


def test_index_by_frequency_then_name(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "state string")
    model = duration.fit_index(rows, ["state"])
    more = spark.createDataFrame([("c",), ("a",), ("b",), ("new",), (None,)], "state string")
    assert [r.state_idx for r in model.transform(more).collect()] == [0.0, 1.0, 2.0, 3.0, 3.0]
    assert duration.bins_for(model) == 128 and duration.bins_for(model, 2) == 4


def test_duration_tree_with_many_states(spark):
    rows = stage(
        spark.range(3000).select(
            (F.col("id") % 24).cast("int").alias("hour"),
            (F.col("id") % 4 + 1).cast("string").alias("severity"),
            F.concat(F.lit("S"), (F.col("id") % 50).cast("string")).alias("state"),
            (F.col("id") % 100 / 10).alias("distance"),
            (F.col("id") % 50 * 10 + F.col("id") % 24 + 1.0).alias("duration_minutes"),
        ),
        "durations",
    )
    search = duration.search_duration_tree(rows, rows, (3, 6), (2,))
    by_depth = {r["max_depth"]: r["training_rmse"] for r in search.rows}
    assert by_depth[6] < by_depth[3]
    assert search.model.stages[-1].numFeatures == 4
    again = duration.search_duration_tree(rows, rows, (3, 6), (2,), storage=None, parallelism=2)
    assert [r["valid_rmse"] for r in again.rows] == pytest.approx([r["valid_rmse"] for r in search.rows])


@pytest.fixture(scope="module")
def profile(spark):
    spread = lambda salt, width: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(width)) * 1.0
    return stage(
        spark.range(300).select(
            F.concat(F.lit("c"), F.col("id").cast("string")).alias("city"),
            (spread(1, 30) / 10 + 1).alias("avg_severity"),
            (spread(2, 8) + F.col("id") % 5 * 15).alias("avg_temp"),
            (spread(3, 8) + F.col("id") % 5 * 20).alias("avg_humidity"),
            spread(4, 10).alias("avg_visibility"),
            (spread(5, 10) / 100).alias("avg_precip"),
        ),
        "profile",
    )


@pytest.mark.parametrize("scale", [False, True])
def test_clusters_ignore_the_layout(profile, scale):
    got = [
        {r.city: r.cluster for r in clusters.cluster_cities(frame, scale=scale).table.collect()}
        for frame in (profile, profile.repartition(1), profile.repartition(7))
    ]
    assert got[0] == got[1] == got[2] and set(got[0].values()) == set(range(5))


def test_cities_sit_at_their_nearest_centre(profile):
    result = clusters.cluster_cities(profile)
    centres = result.model.stages[-1].clusterCenters()
    order = sorted(range(5), key=lambda n: (centres[n][1], centres[n][2]))
    for row in result.table.collect():
        point = [row[name] for name in clusters.FEATURES]
        distance = [math.dist(point, centre) for centre in centres]
        assert order[row.cluster] == distance.index(min(distance))
    summary = clusters.cluster_profile(result.table).collect()
    temps = [r.mean_temp for r in summary]
    assert len(summary) == 5 and temps == sorted(temps)


def test_clusters_in_several_partitions(profile):
    first = clusters.cluster_cities(profile, partitions=4).table.collect()
    again = clusters.cluster_cities(profile.repartition(9), partitions=4).table.collect()
    assert sorted(first) == sorted(again)
