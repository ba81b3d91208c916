"""City-by-day panel, city profile, hotspots and lags.

One rollup to (city, day) carries counts and sums. Panel, profile and hotspot
list are all derived from it, so the incident table is read once, folds inside
each task, and everything after works on at most cities x days rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from incidara.functions import exact_sum, mean_from
from incidara.operators.quality import drop_nulls
from incidara.schema import PANEL_MEASURES

CITY = ("city",)

# Lags in observed days, cities in the hotspot list and in the series charts.
LAGS = (1, 7)
TOP_HOTSPOTS = 20
TOP_SERIES = 5


def with_date(incidents: DataFrame) -> DataFrame:
    return incidents.withColumn("date", F.to_date("start_time"))


def day_rollup(
    incidents: DataFrame,
    keys: Sequence[str] = CITY,
    measures: Mapping[str, str] = PANEL_MEASURES,
    exact_scale: int | None = None,
) -> DataFrame:
    """Per key and day: non-null ids, and sum and non-null count per measure."""
    folded: list[Column] = [F.count("id").alias("accident_count")]
    for name, source in measures.items():
        folded.append(exact_sum(source, exact_scale).alias(f"{name}_sum"))
        folded.append(F.count(source).alias(f"{name}_n"))
    return incidents.groupBy(*keys, "date").agg(*folded)


def panel_from_rollup(
    rollup: DataFrame,
    keys: Sequence[str] = CITY,
    measures: Mapping[str, str] = PANEL_MEASURES,
) -> DataFrame:
    """Count and means per key and day; rows without key or day are left out."""
    return drop_nulls(rollup, [*keys, "date"]).select(
        *keys,
        "date",
        "accident_count",
        *[mean_from(F.col(f"{m}_sum"), F.col(f"{m}_n")).alias(m) for m in measures],
    )


def city_day_panel(
    incidents: DataFrame, keys: Sequence[str] = CITY, exact_scale: int | None = None
) -> DataFrame:
    """Incidents per city and day with the means of that day's measures.

    Only days that have incidents exist. Cities of the same name in different
    states are one city unless ``keys`` says ("state", "city").
    """
    return panel_from_rollup(day_rollup(incidents, keys, exact_scale=exact_scale), keys)


def city_day_join(
    incidents: DataFrame, keys: Sequence[str] = CITY, exact_scale: int | None = None
) -> DataFrame:
    """The same panel as a left join of counts and means.

    Two scans and two shuffles where ``city_day_panel`` needs one of each;
    kept for callers that hold the two sides as separate tables.
    """
    clean = drop_nulls(incidents, [*keys, "date"])
    counts = clean.groupBy(*keys, "date").agg(F.count("id").alias("accident_count"))
    means = clean.groupBy(*keys, "date").agg(
        *[
            mean_from(exact_sum(source, exact_scale), F.count(source)).alias(name)
            for name, source in PANEL_MEASURES.items()
        ]
    )
    return counts.join(means, [*keys, "date"], "left")


# Profile column -> panel measure it averages over all days.
PROFILE_MEASURES = {
    "avg_severity": "sever",
    "avg_temp": "temp",
    "avg_humidity": "humidity",
    "avg_visibility": "visibility",
    "avg_precip": "precip",
}


def profile_from_rollup(
    rollup: DataFrame, keys: Sequence[str] = CITY, min_count: int = 0
) -> DataFrame:
    """Means per city over all its incidents, out of the day sums."""
    totals = rollup.groupBy(*keys).agg(
        F.sum("accident_count").alias("accident_count"),
        *[F.sum(f"{m}_sum").alias(f"{m}_sum") for m in PROFILE_MEASURES.values()],
        *[F.sum(f"{m}_n").alias(f"{m}_n") for m in PROFILE_MEASURES.values()],
    )
    return totals.filter(F.col("accident_count") >= min_count).select(
        *keys,
        *[
            mean_from(F.col(f"{m}_sum"), F.col(f"{m}_n")).alias(name)
            for name, m in PROFILE_MEASURES.items()
        ],
    )


def city_profile(
    incidents: DataFrame, keys: Sequence[str] = CITY, exact_scale: int | None = None
) -> DataFrame:
    """Means per city, straight from incidents; they need no day."""
    return incidents.groupBy(*keys).agg(
        *[
            mean_from(
                exact_sum(PANEL_MEASURES[m], exact_scale), F.count(PANEL_MEASURES[m])
            ).alias(name)
            for name, m in PROFILE_MEASURES.items()
        ]
    )


def _most(totals: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    # The name breaks ties; sort and limit become one top-k, no global sort.
    return totals.orderBy(F.desc("total_accidents"), *keys).limit(n)


def top_cities(
    incidents: DataFrame, n: int = TOP_HOTSPOTS, keys: Sequence[str] = CITY
) -> DataFrame:
    """The ``n`` cities with most incidents."""
    totals = incidents.groupBy(*keys).agg(F.count("id").alias("total_accidents"))
    return _most(totals, keys, n)


def top_from_counts(
    panel: DataFrame, n: int = TOP_SERIES, keys: Sequence[str] = CITY
) -> DataFrame:
    """The ``n`` cities with most incidents, out of daily counts."""
    totals = panel.groupBy(*keys).agg(F.sum("accident_count").alias("total_accidents"))
    return _most(totals, keys, n)


def lag_features(
    panel: DataFrame, keys: Sequence[str] = CITY, lags: Sequence[int] = LAGS
) -> DataFrame:
    """Counts of earlier observed days of the same city; rows without are dropped.

    Lags step over rows, not calendar days: lag 7 is the seventh observed day
    back. Apply before any date filter, or the first rows lose their history.
    A city's window holds one row per day, however many incidents it has.
    """
    history = Window.partitionBy(*keys).orderBy("date")
    names = {f"lag_{k}": F.lag("accident_count", k).over(history) for k in lags}
    return drop_nulls(panel.withColumns(names), list(names))
