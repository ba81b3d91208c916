"""Distinct counts of any range of days from sketches stored as days land.

A sketch per day and measured value (a column, or the whole row for the duplicate
audit) is some kilobytes whatever the rows. Sketches unite: the count of a range
of days comes from its days' sketches alone, and no landed row is read again. The
exact form is ``quality.duplicate_audit`` or a distinct count over the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Buckets of a sketch, as a power of two.
LG_BUCKETS = 12

_STATE = "day date, measure string, rows long, sketch binary, month date, batch string"


def standard_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Relative standard error of a count out of united sketches."""
    return 1.04 / sqrt(1 << lg_buckets)


def row_value(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """A value that stands for a row (the named columns, all by default): 128 bits of hashes,
    null marks included; equal rows have equal values."""
    names = [F.col(f"`{name}`") for name in cols or df.columns]
    parts = [part for column in names for part in (column, column.isNull())]
    return F.concat_ws(":", F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts))


def distinct_states(
    df: DataFrame, day: Column, measures: Mapping[str, Column], lg_buckets: int = LG_BUCKETS
) -> DataFrame:
    """Rows (day, measure, rows, sketch): non-null values and their sketch, by day.

    One scan; sketches fold in the tasks before the shuffle, so what a task sends
    grows with days x measures, not with rows. Rows without a day have a state of
    their own, of day null.
    """
    values = F.array(
        *[F.struct(F.lit(name).alias("measure"), value.cast("string").alias("value")) for name, value in measures.items()]
    )
    return (
        df.select(day.alias("day"), F.inline(values))
        .groupBy("day", "measure")
        .agg(F.count("value").alias("rows"), F.hll_sketch_agg("value", F.lit(lg_buckets)).alias("sketch"))
    )


def land_distinct(states: DataFrame, path: str, batch: str) -> None:
    """Store a batch's states, a folder per month and batch; the same batch's are replaced."""
    (
        states.withColumns({"month": F.trunc("day", "month"), "batch": F.lit(batch)})
        .hint("rebalance", "month")
        .sortWithinPartitions("month", "batch", "day", "measure")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "batch")
        .parquet(path)
    )


def read_distinct(
    spark: SparkSession, path: str, first_day: date | None = None, last_day: date | None = None
) -> DataFrame:
    """Stored states, of a range of days if given; Spark skips the folders of other months."""
    states = spark.read.schema(_STATE).parquet(path)
    if first_day is not None:
        states = states.filter((F.col("month") >= F.lit(first_day.replace(day=1))) & (F.col("day") >= F.lit(first_day)))
    if last_day is not None:
        states = states.filter((F.col("month") <= F.lit(last_day.replace(day=1))) & (F.col("day") <= F.lit(last_day)))
    return states


def united(states: DataFrame, keys: Sequence[str] = (), lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """Rows (keys, measure, rows, distinct, at_least, at_most) of the states of each group.

    The bounds are three standard errors wide. ``rows`` is exact. Values of a
    batch landed twice under two names count once in ``distinct``, twice in ``rows``.
    """
    wide = 3 * standard_error(lg_buckets)
    merged = states.groupBy(*keys, "measure").agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"),
    )
    return merged.withColumns(
        {
            "at_least": F.floor(F.col("distinct") / (1 + wide)).cast("long"),
            "at_most": F.ceil(F.col("distinct") / (1 - wide)).cast("long"),
        }
    )
