"""The city-day panel kept up to date by mergeable states.

A state per key and day holds what any later question about that day adds up:
rows, and per measure the values seen and both halves of their exact sum. A
batch of incidents (a day's, say) folds to its states once and is stored by
month and batch. Landing reads nothing of what is stored; landing a batch again
replaces it, so a job that was cut off can be run anew. Late records of a day
are one more batch. Panel, profile and hotspots add up states and never read
incidents.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from incidara.functions import halves_sum, sum_halves
from incidara.operators.panel import CITY, panel_from_rollup
from incidara.operators.quality import drop_nulls
from incidara.schema import PANEL_MEASURES

#: Decimals that sums keep.
SCALE = 4


def _parts(measures: Mapping[str, str]) -> list[str]:
    return ["accident_count", *[f"{m}_{part}" for m in measures for part in ("high", "low", "n")]]


def day_states(
    incidents: DataFrame,
    keys: Sequence[str] = CITY,
    measures: Mapping[str, str] = PANEL_MEASURES,
    scale: int = SCALE,
) -> DataFrame:
    """One row per key and day; incidents without key or day are left out."""
    folded = [F.count("id").alias("accident_count")]
    for name, source in measures.items():
        high, low = sum_halves(source, scale)
        folded += [high.alias(f"{name}_high"), low.alias(f"{name}_low"), F.count(source).alias(f"{name}_n")]
    return drop_nulls(incidents, [*keys, "date"]).groupBy(*keys, "date").agg(*folded)


def merge_states(
    states: DataFrame, keys: Sequence[str] = CITY, measures: Mapping[str, str] = PANEL_MEASURES
) -> DataFrame:
    """One row per key and day out of any number of states."""
    return states.groupBy(*keys, "date").agg(*[F.sum(name).alias(name) for name in _parts(measures)])


def land_states(states: DataFrame, path: str, batch: str) -> None:
    """Store a batch's states, a folder per month and batch, sorted by day.

    The same batch's earlier folders are replaced month by month, others are
    not touched. A month the batch no longer has keeps what it had.
    """
    (
        states.withColumns({"month": F.trunc("date", "month"), "batch": F.lit(batch)})
        .hint("rebalance", "month")
        .sortWithinPartitions("month", "batch", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "batch")
        .parquet(path)
    )


def land_incidents(incidents: DataFrame, path: str, batch: str, keys: Sequence[str] = CITY) -> None:
    """Fold a batch of incidents (with ``date``) and store its states."""
    land_states(day_states(incidents, keys), path, batch)


def read_states(
    spark: SparkSession,
    path: str,
    first_day: date | None = None,
    last_day: date | None = None,
    keys: Mapping[str, T.DataType] | None = None,
    measures: Mapping[str, str] = PANEL_MEASURES,
) -> DataFrame:
    """Stored states, of a range of days if given: Spark skips the folders of other months, and
    within a month the row groups of other days.

    ``keys`` names the keys with their types (one string ``city`` unless given).
    """
    fields = [T.StructField(name, kind) for name, kind in (keys or {"city": T.StringType()}).items()]
    fields += [T.StructField(name, T.LongType()) for name in _parts(measures)]
    fields += [T.StructField(name, T.DateType()) for name in ("date", "month")]
    states = spark.read.schema(T.StructType([*fields, T.StructField("batch", T.StringType())])).parquet(path)
    if first_day is not None:
        states = states.filter((F.col("month") >= F.lit(first_day.replace(day=1))) & (F.col("date") >= F.lit(first_day)))
    if last_day is not None:
        states = states.filter((F.col("month") <= F.lit(last_day.replace(day=1))) & (F.col("date") <= F.lit(last_day)))
    return states.drop("month")


def rollup_from_states(
    states: DataFrame,
    keys: Sequence[str] = CITY,
    measures: Mapping[str, str] = PANEL_MEASURES,
    scale: int = SCALE,
) -> DataFrame:
    """What ``panel.day_rollup`` with ``exact_scale`` makes from the incidents: its panel, profile
    and hotspots follow."""
    merged = merge_states(states, keys, measures)
    sums = [
        column
        for m in measures
        for column in (
            halves_sum(F.col(f"{m}_high"), F.col(f"{m}_low"), scale).alias(f"{m}_sum"),
            F.col(f"{m}_n"),
        )
    ]
    return merged.select(*keys, "date", "accident_count", *sums)


def panel_from_states(states: DataFrame, keys: Sequence[str] = CITY) -> DataFrame:
    return panel_from_rollup(rollup_from_states(states, keys), keys)
