"""One query per operator: (session, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from incidara import functions as fn
from incidara.catalog.fixtures import (
    DAILY_BOUNDS,
    EXACT_SCALE,
    incidents_daily,
    incidents_hourly,
    table,
    with_end_time,
)
from incidara.models import cells, clusters, duration, folds, forecast, grouping, hourly, severity
from incidara.models.trees import search_tree
from incidara.models.metrics import rmse_of, tuning_table as tuning_rows
from incidara.operators import (
    counts,
    distinct_state,
    durations,
    heavy,
    map_cells,
    panel,
    panel_state,
    quality,
    sampling,
    series,
    splits,
)
from incidara.plans.cleaning import clean
from incidara.schema import WEATHER_MEASURES, with_incident_names
from incidara.session import fresh_path, pin_time_zone, stage
from incidara.sinks import land_by_year, save_pipeline, write_csv, write_result_csv
from incidara.sources import (
    cluster_by_id,
    load_pipeline,
    read_cluster_profile,
    read_importances,
    read_inferred,
    read_landed,
    read_strings,
    read_table_strings,
    read_typed,
    typed_incidents,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(pin_time_zone(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


STATE = ("state",)
DAY = ["city", "date"]

# Columns whose rows repeat and hold nulls.
REPEATING = [
    "city", "state", "severity", "temperature_f", "visibility_mi", "precipitation_in", "weather_condition",
]

# One small grid point, so that a check run takes seconds.
DEPTH, ITERATIONS, STEP = 3, 8, 0.1
# Features of few values, so that SQL can try every cut.
CALENDAR = ["day_of_week", "month"]


def _panel(spark, sf_dir, keys=panel.CITY):
    return panel.city_day_panel(incidents_daily(spark, sf_dir), keys, EXACT_SCALE)


def _lagged(spark, sf_dir):
    return panel.lag_features(_panel(spark, sf_dir))


def _hourly(spark, sf_dir):
    return counts.with_hours(incidents_hourly(spark, sf_dir))


def _ended(spark, sf_dir):
    return with_end_time(incidents_hourly(spark, sf_dir))


# --- panel, profile, hotspots ---------------------------------------------------------


@query
def city_day_panel(spark, sf_dir):
    return _panel(spark, sf_dir)


@query
def city_day_join(spark, sf_dir):
    return panel.city_day_join(incidents_daily(spark, sf_dir), exact_scale=EXACT_SCALE)


@query
def count_series(spark, sf_dir):
    return series.count_series(_panel(spark, sf_dir))


@query
def lag_features(spark, sf_dir):
    return _lagged(spark, sf_dir).select(*DAY, "accident_count", "lag_1", "lag_7")


@query
def lag_features_state(spark, sf_dir):
    lagged = panel.lag_features(_panel(spark, sf_dir, STATE), STATE)
    return lagged.select("state", "date", "accident_count", "lag_1", "lag_7")


@query
def city_profile(spark, sf_dir):
    return panel.city_profile(incidents_daily(spark, sf_dir), exact_scale=EXACT_SCALE)


@query
def city_profile_rollup(spark, sf_dir):
    rollup = panel.day_rollup(incidents_daily(spark, sf_dir), exact_scale=EXACT_SCALE)
    return panel.profile_from_rollup(rollup)


@query
def top_cities(spark, sf_dir):
    return panel.top_cities(incidents_daily(spark, sf_dir))


@query
def top_cities_test(spark, sf_dir):
    _, _, test = splits.split_by_time(_lagged(spark, sf_dir), DAILY_BOUNDS)
    return panel.top_from_counts(test)


@query
def week_slice(spark, sf_dir):
    return series.week_slice(_panel(spark, sf_dir), 1998, 10)


def _landed(spark, sf_dir):
    """Three batches: history, recent days, late records of those; the last one landed twice."""
    rows = incidents_daily(spark, sf_dir)
    recent, late = F.col("date") >= F.lit(DAILY_BOUNDS.test_start), F.col("id") % 3 == 0
    path = fresh_path(spark, "states")
    panel_state.land_incidents(rows.filter(~recent), path, "history")
    panel_state.land_incidents(rows.filter(recent & ~late), path, "recent")
    for _ in range(2):
        panel_state.land_incidents(rows.filter(recent & late), path, "late")
    return path


@query
def panel_landed(spark, sf_dir):
    """The panel out of stored states equals the one built from all incidents."""
    return panel_state.panel_from_states(panel_state.read_states(spark, _landed(spark, sf_dir)))


@query
def profile_landed(spark, sf_dir):
    states = panel_state.read_states(spark, _landed(spark, sf_dir))
    return panel.profile_from_rollup(panel_state.rollup_from_states(states))


@query
def top_cities_landed(spark, sf_dir):
    """Hotspots of a range of days; other months' folders are not read."""
    states = panel_state.read_states(spark, _landed(spark, sf_dir), date(2000, 7, 1), date(2001, 3, 31))
    return panel.top_from_counts(panel_state.merge_states(states))


@query
def top_cities_heavy(spark, sf_dir):
    """The hotspots without a count of every city: summary, floor, then the cities that can win."""
    incidents = incidents_daily(spark, sf_dir)
    return heavy.top_heavy(incidents, panel.CITY, F.col("id").isNotNull().cast("int"), panel.TOP_HOTSPOTS)


@query
def top_orders_heavy(spark, sf_dir):
    """Orders of largest summed quantity: far more keys than a summary has buckets, and no heavy one."""
    incidents = incidents_daily(spark, sf_dir)
    return heavy.top_heavy(incidents, ["id"], F.col("temperature_f"), 25, "total_quantity")


@query
def distinct_landed(spark, sf_dir):
    """Distinct counts of a range of days from landed sketches, held against the exact ones."""
    incidents = incidents_daily(spark, sf_dir)
    measures = {
        "id": F.col("id"),
        "city": F.col("city"),
        "row": distinct_state.row_value(incidents, ["date", "city", "severity", "weather_condition"]),
    }
    path = fresh_path(spark, "distinct")
    for n in (0, 1):
        batch = incidents.filter(F.pmod("id", F.lit(2)) == n)
        distinct_state.land_distinct(distinct_state.distinct_states(batch, F.col("date"), measures), path, f"half {n}")
    days = date(2000, 7, 1), date(2001, 3, 31)
    united = distinct_state.united(distinct_state.read_distinct(spark, path, *days))
    inside = incidents.filter(F.col("date").between(*map(F.lit, days)))
    values = F.array(*[F.struct(F.lit(m).alias("measure"), v.cast("string").alias("value")) for m, v in measures.items()])
    exact = inside.select(F.inline(values)).groupBy("measure").agg(F.count_distinct("value").alias("exact"))
    return united.join(exact, "measure").select(
        "measure",
        F.col("rows").alias("n_values"),
        "exact",
        F.col("exact").between(F.col("at_least"), F.col("at_most")).alias("within_bounds"),
    )


# --- expressions ----------------------------------------------------------------------


@query
def time_parts(spark, sf_dir):
    day = F.to_date("start_time")
    weekday = F.dayofweek(day)
    return incidents_hourly(spark, sf_dir).select(
        "id",
        day.alias("date"),
        F.hour("start_time").alias("hour"),
        weekday.alias("day_of_week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("iso_week"),
        fn.weekend_flag(weekday).alias("is_weekend"),
    )


@query
def log_target(spark, sf_dir):
    return _panel(spark, sf_dir).select(
        *DAY, F.round(fn.log_target("accident_count"), 9).alias("accident_count_log")
    )


@query
def back_transform(spark, sf_dir):
    count = fn.from_log(fn.log_target("lag_1") - 2)
    return _lagged(spark, sf_dir).select(
        *DAY,
        F.round(count, 9).alias("predicted_count"),
        fn.rounded_count(count).alias("predicted_count_rounded"),
    )


@query
def lenient_parse(spark, sf_dir):
    number = F.col("event_id") % 7
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.when(number == 0, F.lit("bad")).otherwise(F.col("ts").cast("string")).alias("ts"),
        F.when(number == 1, F.lit("x1")).otherwise(F.col("value").cast("string")).alias("distance"),
    )
    return raw.select(
        "id",
        fn.parse_timestamp("ts").cast("timestamp_ntz").alias("ts"),
        fn.parse_double("distance").alias("distance"),
    )


# --- splits and samples ---------------------------------------------------------------


@query
def split_time(spark, sf_dir):
    return splits.split_sizes(_lagged(spark, sf_dir), DAILY_BOUNDS)


@query
def split_bounds(spark, sf_dir):
    return splits.split_bounds(_lagged(spark, sf_dir), DAILY_BOUNDS)


@query
def split_series(spark, sf_dir):
    return series.split_series(_lagged(spark, sf_dir), DAILY_BOUNDS)


@query
def split_hash(spark, sf_dir):
    return incidents_hourly(spark, sf_dir).select("id", splits.key_split_label("id").alias("split"))


@query
def split_hash_fine(spark, sf_dir):
    label = splits.key_split_label("id", 0.125)
    return incidents_hourly(spark, sf_dir).select("id", label.alias("split"))


@query
def split_random(spark, sf_dir):
    train, valid = splits.split_random(incidents_hourly(spark, sf_dir).select("id"))
    return train.withColumn("split", F.lit("train")).unionByName(
        valid.withColumn("split", F.lit("valid"))
    )


@query
def split_random_cover(spark, sf_dir):
    """The random parts together are every row once."""
    train, valid = splits.split_random(incidents_hourly(spark, sf_dir).select("id"))
    return train.unionByName(valid).groupBy("id").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("rows"), F.count("*").alias("ids")
    )


@query
def sample_exact_strata(spark, sf_dir):
    rows = incidents_hourly(spark, sf_dir).select("id", (F.col("id") % 10).alias("bucket"))
    return sampling.sample_exact_strata(rows, ["bucket"], "id", seed=42)


@query
def sample_bernoulli(spark, sf_dir):
    return sampling.sample_bernoulli(incidents_hourly(spark, sf_dir).select("id"), seed=42)


@query
def sample_by_key(spark, sf_dir):
    return sampling.sample_by_key(incidents_hourly(spark, sf_dir).select("id"), "id", seed=42)


# --- hours and severities -------------------------------------------------------------


@query
def hour_severity_counts(spark, sf_dir):
    return counts.hour_severity_counts(_hourly(spark, sf_dir)).orderBy("hours", "severity")


@query
def hour_counts(spark, sf_dir):
    return counts.hour_counts(counts.hour_severity_counts(_hourly(spark, sf_dir))).orderBy("hours")


@query
def severity_slice(spark, sf_dir):
    return counts.severity_slice(counts.hour_severity_counts(_hourly(spark, sf_dir)), 2)


@query
def severity_levels(spark, sf_dir):
    return counts.severity_levels(counts.hour_severity_counts(_hourly(spark, sf_dir)))


def _places(spark, sf_dir):
    """The test tables hold no coordinates: these follow from the ids, a third in one small area."""
    number = F.col("id")
    lat = F.when(number % 3 == 0, 50.0 + number % 100 / 1024).otherwise((number * 7919) % 2880 / 16 - 90.0)
    lon = F.when(number % 3 == 0, 10.0 + number % 77 / 1024).otherwise((number * 104729) % 5760 / 16 - 180.0)
    return incidents_hourly(spark, sf_dir).select("id", lat.alias("latitude"), lon.alias("longitude"))


@query
def map_cell_counts(spark, sf_dir):
    return map_cells.cell_counts(_places(spark, sf_dir), "latitude", "longitude", 8)


@query
def map_cells_split(spark, sf_dir):
    found = stage(map_cells.cell_counts(_places(spark, sf_dir), "latitude", "longitude", 14), "cells")
    return map_cells.split_heavy_cells(found, 100)


# --- durations ------------------------------------------------------------------------


@query
def duration_minutes(spark, sf_dir):
    minutes = fn.duration_minutes("start_time", "end_time")
    return _ended(spark, sf_dir).select("id", F.round(minutes, 9).alias("duration_minutes"))


@query
def duration_filter(spark, sf_dir):
    kept = durations.duration_between(durations.with_duration(_ended(spark, sf_dir)))
    return kept.select("id", F.round("duration_minutes", 9).alias("duration_minutes"))


@query
def duration_model_table(spark, sf_dir):
    rows = durations.duration_model_table(_ended(spark, sf_dir))
    return rows.withColumn("duration_minutes", F.round("duration_minutes", 9))


@query
def duration_by_hour(spark, sf_dir):
    by_hour = durations.state_mean_by_hour(durations.duration_model_table(_ended(spark, sf_dir)))
    return by_hour.select(
        "hour",
        F.round("actual_avg_duration", 6).alias("actual_avg_duration"),
        F.round("predicted_avg_duration", 6).alias("predicted_avg_duration"),
    )


# --- cleaning -------------------------------------------------------------------------


@query
def nonnull_profile(spark, sf_dir):
    return quality.nonnull_profile(incidents_daily(spark, sf_dir, nulls=True))


@query
def row_counts(spark, sf_dir):
    rows = incidents_daily(spark, sf_dir, nulls=True)
    stages = {
        "loaded": F.lit(True),
        "complete_weather": quality.present(rows, WEATHER_MEASURES),
        "complete": quality.present(rows),
    }
    return quality.row_counts(rows, stages)


@query
def drop_any_null(spark, sf_dir):
    return quality.drop_nulls(incidents_daily(spark, sf_dir, nulls=True))


@query
def drop_subset_null(spark, sf_dir):
    rows = incidents_daily(spark, sf_dir, nulls=True)
    return quality.drop_nulls(rows, ["temperature_f", "precipitation_in"])


@query
def impute_mean(spark, sf_dir):
    rows = incidents_daily(spark, sf_dir, nulls=True).select("id", "line_number", *WEATHER_MEASURES)
    filled = quality.impute_mean(rows, WEATHER_MEASURES)
    return filled.withColumns({name: F.round(name, 6) for name in WEATHER_MEASURES})


@query
def duplicate_audit(spark, sf_dir):
    return quality.duplicate_audit(incidents_daily(spark, sf_dir).select("city", "state", "severity"))


@query
def duplicate_audit_hash(spark, sf_dir):
    rows = incidents_daily(spark, sf_dir, nulls=True).select(*REPEATING)
    return quality.duplicate_audit(rows, by_hash=True)


@query
def deduplicate(spark, sf_dir):
    return quality.deduplicate(incidents_daily(spark, sf_dir, nulls=True).select(*REPEATING))


def _orders_csv(spark, sf_dir, header=True):
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "orders-csv")
    write_csv(orders, path, header=header)
    return orders, path


@query
def csv_roundtrip(spark, sf_dir):
    orders, path = _orders_csv(spark, sf_dir)
    return read_typed(spark, path, orders.schema)


@query
def csv_strings(spark, sf_dir):
    """All-string scan, parsed afterwards."""
    orders, path = _orders_csv(spark, sf_dir)
    raw = read_strings(spark, path)
    return raw.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in orders.dtypes])


@query
def csv_headerless(spark, sf_dir):
    orders, path = _orders_csv(spark, sf_dir, header=False)
    return read_typed(spark, path, orders.schema, header=False)


@query
def csv_inferred(spark, sf_dir):
    orders, path = _orders_csv(spark, sf_dir)
    found = read_inferred(spark, path)
    types = ",".join(f"{name}:{kind}" for name, kind in found.dtypes)
    return found.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).withColumn(
        "types", F.lit(types)
    )


@query
def clean_chain(spark, sf_dir):
    """A raw file of more columns than are known, cleaned, read back and counted."""
    rows = incidents_daily(spark, sf_dir, nulls=True)
    raw = with_incident_names(rows).withColumns({"Source": F.lit("s"), "Start_Lat": F.col("severity") + 0.5})
    path = fresh_path(spark, "chain")
    write_csv(raw, f"{path}/raw")
    first = typed_incidents(read_table_strings(spark, f"{path}/raw"))
    clean(first, f"{path}/clean", as_csv=True)
    again = read_table_strings(spark, f"{path}/clean/cleaned")
    daily = typed_incidents(again, any_null_drop=True, keep_rest=False)
    counted = panel.city_day_panel(panel.with_date(daily)).groupBy("city").agg(
        F.count("*").alias("days"), F.sum("accident_count").alias("accidents")
    )
    return counted.withColumn("n_columns", F.lit(len(again.columns)))


@query
def landed_days(spark, sf_dir):
    """Land by year, read a range of days back."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "start_time")
    path = fresh_path(spark, "landed")
    land_by_year(orders, path)
    return read_landed(spark, path, date(1998, 3, 1), date(1999, 2, 15)).drop("start_year")


@query
def hour_result_csv(spark, sf_dir):
    hours = counts.hour_counts(counts.hour_severity_counts(_hourly(spark, sf_dir)))
    path = fresh_path(spark, "hours-csv")
    write_result_csv(hours, path, ["hours"])
    return read_typed(spark, path, hours.schema)


@query
def cluster_profile_file(spark, sf_dir):
    """Means by severity under the published header, written, read back, one group looked up."""
    weather = {"Temperature (F)": "temperature_f", "Humidity (%)": "humidity_pct", "Severity": "severity"}
    weather |= {"Visibility (mi)": "visibility_mi", "Precipitation (in)": "precipitation_in"}
    groups = incidents_daily(spark, sf_dir).groupBy(F.col("severity").alias("Cluster")).agg(
        *[F.round(fn.mean_from(fn.exact_sum(c, EXACT_SCALE), F.count(c)), 6).alias(f"Mean {n}") for n, c in weather.items()]
    )
    path = fresh_path(spark, "profile-csv")
    write_csv(groups, path)
    return cluster_by_id(read_cluster_profile(spark, path), 2).toDF("cluster", "temp", "humidity", "sever", "visibility", "precip")


@query
def importances_file(spark, sf_dir):
    """A table of shares under the published header, written and read back."""
    profile = quality.nonnull_profile(incidents_daily(spark, sf_dir, nulls=True))
    path = fresh_path(spark, "importances-csv")
    write_csv(profile.select(F.col("column_name").alias("Feature"), (F.col("non_null") / 4).alias("Importance")), path)
    return read_importances(spark, path).toDF("feature", "importance")


# --- features and naive errors --------------------------------------------------------


@query
def string_index(spark, sf_dir):
    cols = ["event_type", "state"]
    rows = incidents_hourly(spark, sf_dir).select("id", *cols)
    return duration.fit_index(rows, cols).transform(rows)


@query
def assemble_features(spark, sf_dir):
    return forecast.assembled_values(forecast.feature_table(_panel(spark, sf_dir)))


@query
def rmse_naive(spark, sf_dir):
    labelled = _lagged(spark, sf_dir).select(
        DAILY_BOUNDS.label().alias("split"),
        fn.log_target("accident_count").alias("actual"),
        fn.log_target("lag_1").alias("naive"),
    )
    return labelled.groupBy("split").agg(F.round(rmse_of("actual", "naive"), 6).alias("rmse"))


@query
def city_naive_series(spark, sf_dir):
    _, _, test = splits.split_by_time(_lagged(spark, sf_dir), DAILY_BOUNDS)
    return series.top_city_series(test, "lag_1")


# --- models ---------------------------------------------------------------------------


def _forecast_parts(spark, sf_dir):
    features = stage(forecast.feature_table(_panel(spark, sf_dir)), "features")
    return splits.split_by_time(features, DAILY_BOUNDS)


def _scored_test(spark, sf_dir):
    train, _, test = _forecast_parts(spark, sf_dir)
    model = forecast.fit_forecast(train, DEPTH, ITERATIONS, STEP)
    return forecast.score_forecast(model, test)


@query
def gbt_forecast(spark, sf_dir):
    return _scored_test(spark, sf_dir).select(
        *DAY, "accident_count", "prediction", "predicted_count_rounded"
    )


@query
def gbt_means(spark, sf_dir):
    """Over the training rows boosted variance trees must return the label's mean."""
    train, _, _ = _forecast_parts(spark, sf_dir)
    model = forecast.fit_forecast(train, DEPTH, ITERATIONS, STEP)
    return forecast.score_forecast(model, train).agg(
        F.count("*").alias("rows"),
        F.round(F.avg(forecast.LABEL), 6).alias("mean_label"),
        F.round(F.avg("prediction"), 6).alias("mean_prediction"),
    )


@query
def gbt_exact(spark, sf_dir):
    """Two boosted cuts by weekday or month, scored on later days: each is the one of least
    squared error, the second on twice the residual and weighted by the step."""
    train, _, test = _forecast_parts(spark, sf_dir)
    model = forecast.fit_forecast(train, 1, 2, STEP, features=CALENDAR)
    return forecast.score_forecast(model, test).select(
        *DAY, F.round("prediction", 6).alias("prediction")
    )


@query
def gbt_grid_exact(spark, sf_dir):
    """Validation errors of one and of two such cuts, read from one fit."""
    train, valid, _ = _forecast_parts(spark, sf_dir)
    search = forecast.search_forecast(train, valid, (1,), (1, 2), (STEP,), features=CALENDAR)
    return tuning_rows(spark, search.rows).select(
        "max_iter", F.round("rmse", 6).alias("rmse"), "is_best"
    )


@query
def gbt_grid(spark, sf_dir):
    train, valid, _ = _forecast_parts(spark, sf_dir)
    search = forecast.search_forecast(train, valid, (DEPTH,), (3, 5, ITERATIONS), (STEP,))
    return tuning_rows(spark, search.rows)


# Two spans of half a year with the validation year's origin.
FOLDS = folds.rolling_folds(DAILY_BOUNDS.valid_start, 183, 2)


@query
def fold_sizes(spark, sf_dir):
    return folds.fold_sizes(_lagged(spark, sf_dir), FOLDS)


@query
def fold_errors_naive(spark, sf_dir):
    scored = _lagged(spark, sf_dir).select(
        "date", fn.log_target("accident_count").alias("actual"), fn.log_target("lag_1").alias("naive")
    )
    return folds.fold_errors(scored, FOLDS, "actual", "naive").withColumn("rmse", F.round("rmse", 6))


@query
def fold_grid_exact(spark, sf_dir):
    """One cut by weekday or month, found anew from each fold's training days."""
    features = stage(forecast.feature_table(_panel(spark, sf_dir)), "features")
    search = folds.cross_validate(features, FOLDS, (1,), (1,), (STEP,), CALENDAR)
    return tuning_rows(spark, search.fold_rows).select(
        F.col("fold").cast("int").alias("fold"), F.round("rmse", 6).alias("rmse")
    )


@query
def gbt_importance(spark, sf_dir):
    train, _, _ = _forecast_parts(spark, sf_dir)
    return forecast.importances(spark, forecast.fit_forecast(train, DEPTH, ITERATIONS, STEP))


@query
def city_forecast_series(spark, sf_dir):
    scored = stage(_scored_test(spark, sf_dir), "scored")
    return series.top_city_series(scored, "predicted_count_rounded")


def _staged_hours(spark, sf_dir):
    by_severity = counts.hour_severity_counts(_hourly(spark, sf_dir))
    return stage(counts.hour_counts(by_severity), "hours")


@query
def hour_tree(spark, sf_dir):
    hours = _staged_hours(spark, sf_dir)
    return hourly.score_hours(hourly.search_hour_tree(hours).model, hours)


@query
def hour_tree_means(spark, sf_dir):
    """Trained on all hours, the tree must return the mean count."""
    hours = _staged_hours(spark, sf_dir)
    model = hourly.search_hours(hours, hours, depths=(3,), min_instances=(2,)).model
    return hourly.score_hours(model, hours).agg(
        F.count("*").alias("rows"),
        F.round(F.avg(hourly.LABEL), 6).alias("mean_count"),
        F.round(F.avg("prediction"), 6).alias("mean_prediction"),
    )


@query
def hour_tree_exact(spark, sf_dir):
    """Two levels over all hours: each cut is the one of least squared error."""
    hours = _staged_hours(spark, sf_dir)
    model = hourly.search_hours(hours, hours, depths=(2,), min_instances=(1,)).model
    return model.transform(hours).select("hours", F.round("prediction", 6).alias("prediction"))


@query
def tuning_table(spark, sf_dir):
    return tuning_rows(spark, hourly.search_hour_tree(_staged_hours(spark, sf_dir)).rows)


def _duration_tree(spark, sf_dir):
    rows = stage(durations.duration_model_table(_ended(spark, sf_dir), carry=["id"]), "durations")
    train, valid = splits.split_by_key(rows, "id")
    search = duration.search_duration_tree(train, valid)
    return search.model.transform(train), search.model.transform(valid)


@query
def duration_tree(spark, sf_dir):
    _, valid = _duration_tree(spark, sf_dir)
    return valid.select(*durations.MODEL_COLUMNS, "prediction")


@query
def duration_tree_by_hour(spark, sf_dir):
    _, valid = _duration_tree(spark, sf_dir)
    return durations.mean_duration_by_hour(valid)


@query
def duration_tree_means(spark, sf_dir):
    """Over the training rows a variance tree must return the mean of the label."""
    train, _ = _duration_tree(spark, sf_dir)
    return train.agg(
        F.count("*").alias("rows"),
        F.round(F.avg("duration_minutes"), 6).alias("mean_duration"),
        F.round(F.avg("prediction"), 6).alias("mean_prediction"),
    )


@query
def duration_tree_exact(spark, sf_dir):
    """One cut by hour or severity: the one of least squared error, severities ordered by
    their mean."""
    rows = stage(durations.duration_model_table(_ended(spark, sf_dir), carry=["id"]), "durations")
    train, valid = splits.split_by_key(rows, "id")
    search = duration.search_duration_tree(
        train, valid, (1,), (1,), features=["hour", "severity_idx"]
    )
    return search.model.transform(valid).select("id", F.round("prediction", 6).alias("prediction"))


def _duration_parts(spark, sf_dir):
    rows = stage(durations.duration_model_table(_ended(spark, sf_dir), carry=["id"]), "durations")
    return splits.split_by_key(rows, "id")


@query
def duration_cells(spark, sf_dir):
    """The training rows folded by hour, severity, state and distance bin."""
    train, _ = _duration_parts(spark, sf_dir)
    folded = cells.fold(train, cells.distance_bins(train))
    return folded.select(
        "hour", "severity", "state", F.col(cells.BIN).cast("int").alias("bin"), "rows",
        F.round("label_sum", 6).alias("label_sum"), F.round("label_squares", 4).alias("label_squares"),
    )


@query
def duration_tree_folded(spark, sf_dir):
    """All eight duration trees on cells; the best one's predictions for the validation rows."""
    train, valid = _duration_parts(spark, sf_dir)
    search = cells.search_folded_tree(train, valid)
    return search.model.transform(valid).select(*durations.MODEL_COLUMNS, "prediction")


@query
def duration_tree_folded_exact(spark, sf_dir):
    """One cut by hour or severity on cells: the one of least squared error over the rows."""
    train, valid = _duration_parts(spark, sf_dir)
    search = cells.search_folded_tree(train, valid, (1,), (1,), features=["hour", "severity_idx"])
    return search.model.transform(valid).select("id", F.round("prediction", 6).alias("prediction"))


@query
def duration_fold_check(spark, sf_dir):
    """Trees on cells and on rows (of binned distances) predict the same for every row, and the
    errors of all eight agree."""
    train, valid = _duration_parts(spark, sf_dir)
    folded = cells.search_folded_tree(train, valid)
    plain = search_tree(folded.model.stages[:-1], train, valid, duration.LABEL, max_bins=duration.BINS)
    first = folded.model.transform(valid).withColumnRenamed("prediction", "first")
    both = plain.model.stages[-1].transform(first)
    errors = [
        abs(a[name] - b[name])
        for a, b in zip(folded.rows, plain.rows)
        for name in ("training_rmse", "valid_rmse")
    ]
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.abs(F.col("first") - F.col("prediction")) > 1e-6).alias("mismatches"),
        F.lit(sum(error > 1e-6 for error in errors)).cast("long").alias("wrong_errors"),
    )


def _severity_rows(spark, sf_dir):
    rows = incidents_hourly(spark, sf_dir).withColumn("hour", F.hour("start_time"))
    return stage(rows.select("id", "hour", "severity", "state", "distance"), "severities")


def _severity_parts(spark, sf_dir):
    return splits.split_by_key(_severity_rows(spark, sf_dir), "id")


@query
def severity_tree(spark, sf_dir):
    train, valid = _severity_parts(spark, sf_dir)
    return severity.fit_severity(train).transform(valid).select("id", "severity", "predicted")


@query
def severity_tree_exact(spark, sf_dir):
    """One cut by hour: the one of least Gini impurity; each side says its most frequent class."""
    train, valid = _severity_parts(spark, sf_dir)
    scored = severity.fit_severity(train, 1, ["hour"], []).transform(valid)
    share = F.array_max(vector_to_array("probability"))
    return scored.select("id", "predicted", F.round(share, 6).alias("share"))


def _next_severity(spark, sf_dir):
    """A naive predictor: the class whose number follows from the hour."""
    rows = _severity_rows(spark, sf_dir)
    return rows.withColumn("predicted", (1 + F.col("hour") % 4).cast("string"))


@query
def severity_confusion(spark, sf_dir):
    return severity.confusion(_next_severity(spark, sf_dir))


@query
def severity_measures(spark, sf_dir):
    found = severity.class_measures(severity.confusion(_next_severity(spark, sf_dir)))
    return found.withColumns({name: F.round(name, 9) for name in ("precision", "recall", "f1")})


def _profile(spark, sf_dir):
    rollup = panel.day_rollup(incidents_daily(spark, sf_dir), exact_scale=EXACT_SCALE)
    return stage(panel.profile_from_rollup(rollup), "profile")


@query
def city_groups(spark, sf_dir):
    found = grouping.group_cities(_profile(spark, sf_dir))
    return found.table.select("city", "avg_temp", "avg_humidity", "cluster")


@query
def city_groups_line(spark, sf_dir):
    """Three groups by one measure: SQL tries every pair of cuts of the sorted cities."""
    found = grouping.group_cities(_profile(spark, sf_dir), k=3, features=["avg_temp"])
    return found.table.select("city", "cluster")


@query
def city_groups_check(spark, sf_dir):
    """Each centre is the mean of its cities, each city is at its nearest, and no move of one city
    to another group lowers the cost; worked out from the table alone."""
    table = stage(grouping.group_cities(_profile(spark, sf_dir)).table, "groups")
    means = [F.avg(name).alias(f"mean_{name}") for name in clusters.FEATURES]
    sizes = table.groupBy("cluster").agg(F.count("*").alias("size"), *means)
    whole = sizes.agg(F.sort_array(F.collect_list(F.struct("cluster", "size", *[f"mean_{n}" for n in clusters.FEATURES]))).alias("g"))
    groups = whole.first().g  # one entry a group

    def squared(group):
        return sum(((F.col(n) - group[f"mean_{n}"]) ** 2 for n in clusters.FEATURES), F.lit(0.0))

    own = F.get(F.array(*[squared(g) for g in groups]), F.col("cluster"))
    leave = F.get(F.array(*[F.lit(g["size"] / max(g["size"] - 1, 1)) for g in groups]), F.col("cluster"))
    alone = F.get(F.array(*[F.lit(g["size"] == 1) for g in groups]), F.col("cluster"))
    away = F.lit(False)
    better = F.lit(False)
    for number, g in enumerate(groups):
        other = F.col("cluster") != number
        away = away | (other & (squared(g) < own * (1 - 1e-9)))
        join = squared(g) * (g["size"] / (g["size"] + 1))
        better = better | (other & ~alone & (join < own * leave * (1 - 1e-6)))
    return table.agg(
        F.count("*").alias("cities"),
        F.count_distinct("cluster").alias("groups"),
        F.count_if(away).alias("misplaced"),
        F.count_if(better).alias("better_moves"),
    )


def _clusters(spark, sf_dir):
    rollup = panel.day_rollup(incidents_daily(spark, sf_dir), exact_scale=EXACT_SCALE)
    return clusters.cluster_cities(stage(panel.profile_from_rollup(rollup), "profile"))


@query
def city_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir).table.select("city", "avg_temp", "avg_humidity", "cluster")


@query
def cluster_profile(spark, sf_dir):
    return clusters.cluster_profile(_clusters(spark, sf_dir).table)


@query
def cluster_profile_total(spark, sf_dir):
    """Group means weighted by their cities add up to the mean over all cities."""
    found = _clusters(spark, sf_dir).table
    sizes = found.groupBy("cluster").agg(F.count("*").alias("n"))
    joined = clusters.cluster_profile(found).join(sizes, "cluster")
    weighted = [
        F.round(F.sum(F.col(f"mean_{m}") * F.col("n")) / F.sum("n"), 6).alias(f"mean_{m}")
        for m in ("temp", "humidity", "severity", "visibility", "precip")
    ]
    return joined.agg(F.sum("n").alias("cities"), F.count("*").alias("groups"), *weighted)


@query
def cluster_nearest(spark, sf_dir):
    """Every city must sit in the group with the nearest centre."""
    found = _clusters(spark, sf_dir)

    def squared(centre):
        offsets = [F.col(name) - value for name, value in zip(clusters.FEATURES, centre)]
        return sum((offset * offset for offset in offsets), F.lit(0.0))

    distances = F.array(*[squared(centre) for centre in found.centres])
    away = F.get(distances, F.col("cluster")) > F.array_min(distances) * (1 + 1e-9)
    return found.table.agg(F.count("*").alias("cities"), F.count_if(away).alias("misplaced"))


@query
def model_roundtrip(spark, sf_dir):
    hours = _staged_hours(spark, sf_dir)
    model = hourly.search_hour_tree(hours).model
    path = fresh_path(spark, "hour-model")
    save_pipeline(model, path)
    first = model.transform(hours).withColumnRenamed("prediction", "first").drop("features")
    both = load_pipeline(path).transform(first)
    same = F.col("first").eqNullSafe(F.col("prediction"))
    return both.agg(F.count("*").alias("rows"), F.count_if(~same).alias("mismatches"))
