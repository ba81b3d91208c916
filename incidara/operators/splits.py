"""Training, validation and test splits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

# First validation and test day, the 80/20 shares, the seed,
# and the height of the bound labels as a share of the largest training count.
VALID_START = date(2021, 1, 1)
TEST_START = date(2022, 1, 1)
TRAIN_SHARE = 0.8
SEED = 42
LABEL_HEIGHT = 0.95


@dataclass(frozen=True)
class TimeBounds:
    """Training before ``valid_start``, test from ``test_start`` on."""

    valid_start: date = VALID_START
    test_start: date = TEST_START

    def label(self, day: str = "date") -> Column:
        """train / valid / test as a column; null for a null day."""
        when = F.col(day)
        return (
            F.when(when >= F.lit(self.test_start), F.lit("test"))
            .when(when >= F.lit(self.valid_start), F.lit("valid"))
            .when(when.isNotNull(), F.lit("train"))
        )


def split_by_time(
    df: DataFrame, bounds: TimeBounds = TimeBounds(), day: str = "date"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training, validation and test part, each a plain range filter."""
    when = F.col(day)
    return (
        df.filter(when < F.lit(bounds.valid_start)),
        df.filter((when >= F.lit(bounds.valid_start)) & (when < F.lit(bounds.test_start))),
        df.filter(when >= F.lit(bounds.test_start)),
    )


def split_sizes(df: DataFrame, bounds: TimeBounds = TimeBounds()) -> DataFrame:
    labelled = df.select(bounds.label().alias("split")).filter("split is not null")
    return labelled.groupBy("split").agg(F.count("*").alias("rows"))


def split_bounds(df: DataFrame, bounds: TimeBounds = TimeBounds()) -> DataFrame:
    """First validation and test day present, and the height of their labels.

    One global aggregation (a single row out of each task), then two rows.
    """
    part = bounds.label()
    facts = df.agg(
        F.min(F.when(part == "valid", F.col("date"))).alias("valid"),
        F.min(F.when(part == "test", F.col("date"))).alias("test"),
        (F.max(F.when(part == "train", F.col("accident_count"))) * LABEL_HEIGHT).alias("text_height"),
    )
    rows = facts.unpivot(["text_height"], ["valid", "test"], "split", "first_date")
    return rows.select("split", "first_date", "text_height")


def split_random(
    df: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Random split. The rows chosen depend on how ``df`` is partitioned; use
    ``split_by_key`` where a repeated run must choose the same rows."""
    train, valid = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, valid


def key_height(key: str | Column) -> Column:
    """A number in [0, 1) fixed by the key's value alone (md5, first 32 bits)."""
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(column.cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32


def key_split_label(key: str | Column, train_share: float = TRAIN_SHARE) -> Column:
    """train where the key's height is below the share, else valid; so is a null key."""
    if not 0 < train_share < 1:
        raise ValueError(f"the training share must be between 0 and 1, not {train_share}")
    return F.when(key_height(key) < train_share, F.lit("train")).otherwise(F.lit("valid"))


def split_by_key(
    df: DataFrame, key: str | Column, train_share: float = TRAIN_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row key: no shuffle, the same on every run."""
    label = key_split_label(key, train_share)
    return df.filter(label == "train"), df.filter(label == "valid")
