"""Daily incident counts per city with boosted trees.

The day's own weather and mean severity are features, so this explains a day
given its conditions; pass ``features=PAST_FEATURES`` to leave them out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from incidara.functions import from_log, log_target, rounded_count, with_calendar
from incidara.models.metrics import PARALLEL_FITS, first_best, run_each
from incidara.operators.panel import CITY, lag_features
from incidara.session import shared_dir

# Feature order, seed and search grid.
FEATURES = [
    "day_of_week", "month", "is_weekend",
    "temp", "humidity", "visibility", "precip", "sever",
    "lag_1", "lag_7", "quarter",
]
SEED = 42
DEPTHS = (3, 4, 5, 6)
ITERATIONS = (80, 100, 120, 150)
STEPS = (0.01, 0.03, 0.05, 0.07, 0.1)

PAST_FEATURES = ["day_of_week", "month", "is_weekend", "lag_1", "lag_7", "quarter"]
LABEL = "accident_count_log"
CHECKPOINT_EVERY = 10


def feature_table(panel: DataFrame, keys: Sequence[str] = CITY) -> DataFrame:
    """Panel with calendar, lags and log target; lags before any date filter."""
    return with_calendar(lag_features(panel, keys)).withColumn(LABEL, log_target("accident_count"))


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    """A missing feature value raises."""
    return VectorAssembler(inputCols=list(features), outputCol="features")


def assembled_values(
    table: DataFrame, keys: Sequence[str] = CITY, features: Sequence[str] = FEATURES
) -> DataFrame:
    """The feature vectors spelled out: one row per key, day and position."""
    vectors = assembler(features).transform(table)
    return vectors.select(
        *keys, "date", F.posexplode(vector_to_array("features")).alias("position", "value")
    )


def _regressor(depth: int, iterations: int, step: float, seed: int) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features",
        labelCol=LABEL,
        maxDepth=depth,
        maxIter=iterations,
        stepSize=step,
        seed=seed,
        checkpointInterval=CHECKPOINT_EVERY,
    )


def fit_forecast(
    train: DataFrame,
    depth: int,
    iterations: int,
    step: float,
    features: Sequence[str] = FEATURES,
    seed: int = SEED,
) -> PipelineModel:
    """One model: assembler and boosted trees as a pipeline."""
    shared_dir(train.sparkSession)  # boosting checkpoints its running error there
    vectors = assembler(features)
    ready = vectors.transform(train).select("features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trees = _regressor(depth, iterations, step, seed).fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel(stages=[vectors, trees])


@dataclass(frozen=True)
class Search:
    model: PipelineModel
    rows: list[dict[str, Any]]

    @property
    def best(self) -> dict[str, Any]:
        return next(row for row in self.rows if row["is_best"])


def search_forecast(
    train: DataFrame,
    valid: DataFrame,
    depths: Sequence[int] = DEPTHS,
    iterations: Sequence[int] = ITERATIONS,
    steps: Sequence[float] = STEPS,
    features: Sequence[str] = FEATURES,
    seed: int = SEED,
    parallelism: int = PARALLEL_FITS,
) -> Search:
    """Grid search; the first grid point with the least validation error wins.

    With a fixed seed and no row subsampling the first n trees are the model
    of n iterations. So each (depth, step) is fitted once, with the largest
    iteration count, and the error of every prefix is read in one pass over
    the validation rows: 20 fits for the 80 points of the full grid. Only a
    winner with fewer iterations is fitted again.

    Give ``train`` and ``valid`` as staged tables: every fit reads them.
    """
    spark = train.sparkSession
    shared_dir(spark)
    vectors = assembler(features)

    def ready(part: DataFrame) -> DataFrame:
        return vectors.transform(part).select("features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)

    train_ready, valid_ready = ready(train), ready(valid)
    longest = max(iterations)

    def errors(point: tuple[int, float]) -> tuple[GBTRegressionModel, list[float]]:
        depth, step = point
        trees = _regressor(depth, longest, step, seed).fit(train_ready)
        return trees, trees.evaluateEachIteration(valid_ready, "squared")

    try:
        points = [(depth, step) for depth in depths for step in steps]
        fitted = dict(zip(points, run_each(spark, errors, points, parallelism)))
        rows = first_best(
            [
                {
                    "max_depth": depth,
                    "max_iter": count,
                    "step_size": float(step),
                    "rmse": fitted[depth, step][1][count - 1] ** 0.5,
                }
                for depth in depths
                for count in iterations
                for step in steps
            ],
            "rmse",
        )
        best = next(row for row in rows if row["is_best"])
        trees = fitted[best["max_depth"], best["step_size"]][0]
        if best["max_iter"] != longest:
            trees = _regressor(best["max_depth"], best["max_iter"], best["step_size"], seed).fit(
                train_ready
            )
    finally:
        train_ready.unpersist()
        valid_ready.unpersist()
    return Search(PipelineModel(stages=[vectors, trees]), rows)


def score_forecast(model: PipelineModel, table: DataFrame) -> DataFrame:
    """Add prediction (log scale), predicted_count and its rounded form."""
    scored = model.transform(table).drop("features")
    return scored.withColumn("predicted_count", from_log("prediction")).withColumn(
        "predicted_count_rounded", rounded_count("predicted_count")
    )


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature importances by name, largest first."""
    vectors, trees = model.stages
    rows = list(zip(vectors.getInputCols(), trees.featureImportances.toArray().tolist()))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def search_log(search: Search, test_rmse: float) -> list[str]:
    """The tuning log as text lines."""
    # The line formats of the published log.
    lines = []
    for row in search.rows:
        lines.append(
            f"Training with maxDepth={row['max_depth']}, maxIter={row['max_iter']}, "
            f"stepSize={row['step_size']}"
        )
        lines.append(f"→ RMSE: {row['rmse']}")
    best = search.best
    lines.append(f"Best RMSE: {best['rmse']}")
    lines.append(
        f"Best Params: maxDepth={best['max_depth']}, maxIter={best['max_iter']}, "
        f"stepSize={best['step_size']}"
    )
    lines.append(f"LOG RMSE on testing data: {test_rmse}")
    return lines
