"""Error measures and tuning tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from math import isnan
from multiprocessing.pool import ThreadPool
from typing import Any, TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

PARALLEL_FITS = 4  # fits that share the cluster; a level of a tree is a short job

T = TypeVar("T")
R = TypeVar("R")


def rmse_of(label: str | Column, prediction: str | Column) -> Column:
    """Root mean squared error as an aggregate, usable in any ``agg``."""
    error = _col(label) - _col(prediction)
    return F.sqrt(F.avg(error * error))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rmse(scored: DataFrame, label: str, prediction: str = "prediction") -> float:
    evaluator = RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse")
    return evaluator.evaluate(scored)


def rmse_each(models: Sequence[Model], table: DataFrame, label: str) -> list[float]:
    """Errors of several models over ``table`` in a single pass.

    One pass also means one summation order, so models with equal
    predictions have equal errors to the last bit.
    """
    scored, names = table, [f"_prediction_{n}" for n in range(len(models))]
    for model, name in zip(models, names):
        scored = model.copy({model.predictionCol: name}).transform(scored)
    row = scored.agg(*[rmse_of(label, name).alias(name) for name in names]).first()
    return [float("nan") if row[name] is None else row[name] for name in names]


def run_each(
    spark: SparkSession, work: Callable[[T], R], items: Sequence[T], parallelism: int = PARALLEL_FITS
) -> list[R]:
    """``work`` on every item, up to ``parallelism`` Spark jobs at a time."""
    if parallelism <= 1:
        return [work(item) for item in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def first_best(rows: Iterable[dict[str, Any]], error: str) -> list[dict[str, Any]]:
    """Mark the first row with the least error; NaN never wins."""
    marked = [dict(row, is_best=False) for row in rows]
    usable = [row for row in marked if not isnan(row[error])]
    if not usable:
        raise ValueError(f"no grid point has a {error}; is the validation part empty?")
    min(usable, key=lambda row: row[error])["is_best"] = True
    return marked


def tuning_table(spark: SparkSession, rows: Sequence[dict[str, Any]]) -> DataFrame:
    """Tuning results (one row per grid point) as a table."""
    return spark.createDataFrame([Row(**row) for row in rows])
