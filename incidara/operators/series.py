"""Count series: the numbers behind the charts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from incidara.functions import iso_week_dates
from incidara.operators.panel import CITY, TOP_SERIES, top_from_counts
from incidara.operators.splits import TimeBounds


def count_series(panel: DataFrame, keys: Sequence[str] = CITY) -> DataFrame:
    return panel.select(*keys, "date", "accident_count").orderBy(*keys, "date")


def week_slice(
    panel: DataFrame, year: int, week: int, keys: Sequence[str] = CITY
) -> DataFrame:
    """Counts of one ISO week within one calendar year, in date order.

    The week is turned into date ranges on the day column, which Spark moves
    below the panel's grouping and down to the scan; a test on year() and
    weekofyear() would have to read every day.
    """
    days = [
        F.col("date").between(F.lit(first), F.lit(last))
        for first, last in iso_week_dates(year, week)
    ]
    chosen = reduce(Column.__or__, days, F.lit(False))
    return count_series(panel.filter(chosen), keys)


def split_series(
    panel: DataFrame, bounds: TimeBounds = TimeBounds(), keys: Sequence[str] = CITY
) -> DataFrame:
    labelled = panel.select(*keys, "date", "accident_count", bounds.label().alias("split"))
    return labelled.orderBy(*keys, "date")


def top_city_series(
    scored: DataFrame, predicted: str, n: int = TOP_SERIES, keys: Sequence[str] = CITY
) -> DataFrame:
    """Actual and predicted counts per day for the ``n`` largest cities.

    How the cities are joined is left to Spark's own check of their size.
    """
    largest = top_from_counts(scored, n, keys).select(*keys)
    return (
        scored.join(largest, list(keys), "left_semi")
        .select(
            *keys,
            "date",
            F.col("accident_count").alias("actual"),
            F.col(predicted).alias("predicted"),
        )
        .orderBy(*keys, "date")
    )
