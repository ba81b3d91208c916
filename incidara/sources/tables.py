"""Incident tables landed as Parquet."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_landed(
    spark: SparkSession,
    path: str,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """A table written by ``land_by_year``, optionally for a range of days.

    The range is put on ``start_year`` too, so Spark skips whole years, and
    on ``start_time`` itself, so it skips row groups within a year.
    """
    table = spark.read.parquet(path)
    if first_day is not None:
        table = table.filter(
            (F.col("start_year") >= first_day.year)
            & (F.col("start_time") >= F.lit(first_day))
        )
    if last_day is not None:
        table = table.filter(
            (F.col("start_year") <= last_day.year)
            & (F.col("start_time") < F.lit(last_day + timedelta(days=1)))
        )
    return table
