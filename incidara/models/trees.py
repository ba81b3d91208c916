"""Grid search of a decision tree, shared by the hour and duration models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame

from incidara.models.metrics import PARALLEL_FITS, first_best, rmse_each, run_each

# Search grid and MLlib's usual number of bins.
DEPTHS = (3, 4, 5, 6)
MIN_INSTANCES = (2, 3)
BINS = 32


@dataclass(frozen=True)
class TreeSearch:
    model: PipelineModel
    rows: list[dict[str, Any]]


def search_tree(
    prepare: Sequence[Transformer],
    train: DataFrame,
    valid: DataFrame,
    label: str,
    depths: Sequence[int] = DEPTHS,
    min_instances: Sequence[int] = MIN_INSTANCES,
    max_bins: int = BINS,
    parallelism: int = PARALLEL_FITS,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
) -> TreeSearch:
    """Fit every grid point; the least validation error wins.

    ``prepare`` holds fitted stages ending in a ``features`` column. They run
    once, not once per grid point. All trees are scored together, in one pass
    over each part. ``storage`` keeps the feature vectors between fits; with
    None every fit reads the staged table again. MLlib itself keeps a binned
    copy of the table per fit that runs, some 90 bytes per row, whatever
    ``storage`` is: for a table larger than the executors' disks can hold
    give ``parallelism=1`` as well.
    """
    spark = train.sparkSession
    stages = PipelineModel(stages=list(prepare))

    def ready(part: DataFrame) -> DataFrame:
        vectors = stages.transform(part).select("features", label)
        return vectors.persist(storage) if storage else vectors

    train_ready, valid_ready = ready(train), ready(valid)

    def fit(point: tuple[int, int]) -> DecisionTreeRegressionModel:
        depth, smallest = point
        tree = DecisionTreeRegressor(
            labelCol=label,
            featuresCol="features",
            maxDepth=depth,
            minInstancesPerNode=smallest,
            maxBins=max_bins,
        )
        return tree.fit(train_ready)

    try:
        points = [(depth, smallest) for depth in depths for smallest in min_instances]
        trees = run_each(spark, fit, points, parallelism)
        errors = zip(
            rmse_each(trees, train_ready, label), rmse_each(trees, valid_ready, label)
        )
    finally:
        if storage:
            train_ready.unpersist()
            valid_ready.unpersist()
    rows = first_best(
        [
            {
                "max_depth": depth,
                "min_instances": smallest,
                "training_rmse": on_train,
                "valid_rmse": on_valid,
            }
            for (depth, smallest), (on_train, on_valid) in zip(points, errors)
        ],
        "valid_rmse",
    )
    best = next(n for n, row in enumerate(rows) if row["is_best"])
    return TreeSearch(PipelineModel(stages=[*prepare, trees[best]]), rows)
