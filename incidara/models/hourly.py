"""Incident counts by hour of day with a decision tree (at most 24 rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from incidara.models.trees import DEPTHS, MIN_INSTANCES, TreeSearch, search_tree
from incidara.operators.quality import drop_nulls
from incidara.operators.splits import SEED, TRAIN_SHARE, split_random

LABEL = "accident_count"


def split_hours(
    counts: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Random split of the hours, the same however the counts are partitioned.

    The table has one row per hour of day whatever the input size, so a
    single sorted partition is enough.
    """
    hours = drop_nulls(counts, ["hours"]).repartition(1).sortWithinPartitions("hours")
    return split_random(hours, train_share, seed)


def search_hours(
    train: DataFrame,
    valid: DataFrame,
    depths: Sequence[int] = DEPTHS,
    min_instances: Sequence[int] = MIN_INSTANCES,
) -> TreeSearch:
    vectors = VectorAssembler(inputCols=["hours"], outputCol="features")
    return search_tree([vectors], train, valid, LABEL, depths, min_instances)


def search_hour_tree(
    counts: DataFrame,
    depths: Sequence[int] = DEPTHS,
    min_instances: Sequence[int] = MIN_INSTANCES,
    seed: int = SEED,
) -> TreeSearch:
    """Give ``counts`` staged: all fits and scores read it."""
    train, valid = split_hours(counts, seed=seed)
    return search_hours(train, valid, depths, min_instances)


def score_hours(model: PipelineModel, counts: DataFrame) -> DataFrame:
    """All hours, training ones included, with the prediction."""
    scored = model.transform(drop_nulls(counts, ["hours"]))
    return scored.select("hours", LABEL, "prediction").orderBy("hours")
