"""Daily forecast per city, with hotspots, city groups and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from incidara.models.clusters import cluster_profile
from incidara.models.forecast import (
    DEPTHS,
    FEATURES,
    ITERATIONS,
    LABEL,
    STEPS,
    Search,
    feature_table,
    importances,
    score_forecast,
    search_forecast,
    search_log,
)
from incidara.models.grouping import group_cities
from incidara.models.metrics import PARALLEL_FITS, rmse, tuning_table
from incidara.operators.panel import (
    CITY,
    TOP_HOTSPOTS,
    day_rollup,
    panel_from_rollup,
    profile_from_rollup,
    top_from_counts,
    with_date,
)
from incidara.operators.quality import drop_nulls
from incidara.operators.series import split_series, top_city_series
from incidara.operators.splits import TimeBounds, split_bounds, split_by_time
from incidara.schema import PANEL_MEASURES
from incidara.session import stage
from incidara.sinks import save_pipeline, write_lines, write_table


def daily_forecast(
    incidents: DataFrame,
    out: str,
    keys: Sequence[str] = CITY,
    bounds: TimeBounds = TimeBounds(),
    depths: Sequence[int] = DEPTHS,
    iterations: Sequence[int] = ITERATIONS,
    steps: Sequence[float] = STEPS,
    features: Sequence[str] = FEATURES,
    required: Sequence[str] | None = None,
    parallelism: int = PARALLEL_FITS,
    groups: bool = True,
    exact_scale: int | None = None,
) -> Search:
    """Run the whole analysis and write its tables under ``out``.

    The incident table is read once, for the rollup to (city, day); that
    small table is staged and everything else is derived from it.
    ``required`` names the columns whose missing values drop a row (``None``:
    those that the analysis uses); ``exact_scale`` keeps sums to that many
    decimals, so that a repeated run gives the same means.
    """
    spark = incidents.sparkSession
    if required is None:
        required = ["start_time", *keys, *PANEL_MEASURES.values()]
    usable = with_date(drop_nulls(incidents, required))
    rollup = stage(day_rollup(usable, keys, exact_scale=exact_scale), "rollup")

    write_table(top_from_counts(rollup, TOP_HOTSPOTS, keys), f"{out}/top_cities")
    if groups:
        profile = stage(profile_from_rollup(rollup, keys), "profile")
        groups_found = group_cities(profile, keys)
        write_table(groups_found.table, f"{out}/city_clusters")
        write_table(cluster_profile(groups_found.table), f"{out}/cluster_profile")

    table = stage(feature_table(panel_from_rollup(rollup, keys), keys), "features")
    write_table(split_series(table, bounds, keys), f"{out}/split_series")
    write_table(split_bounds(table, bounds), f"{out}/split_bounds")

    train, valid, test = split_by_time(table, bounds)
    search = search_forecast(
        train, valid, depths, iterations, steps, features, parallelism=parallelism
    )
    save_pipeline(search.model, f"{out}/model")
    write_table(tuning_table(spark, search.rows), f"{out}/tuning")
    write_table(importances(spark, search.model), f"{out}/importances")

    scored = score_forecast(search.model, test)
    write_table(scored, f"{out}/forecast")
    scored = spark.read.schema(scored.schema).parquet(f"{out}/forecast")
    write_lines(spark, search_log(search, rmse(scored, LABEL)), f"{out}/tuning_log")
    write_table(
        top_city_series(scored, "predicted_count_rounded", keys=keys), f"{out}/city_series"
    )
    return search
