"""Cross-validation of the forecast with a rolling origin.

Each fold trains on all days before its origin and validates on a span of days
from there, so no fold learns from days after those it is judged by. Spans
don't overlap; a row is validated at most once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from incidara.models import forecast
from incidara.models.metrics import PARALLEL_FITS, first_best, rmse_of, run_each
from incidara.session import shared_dir


@dataclass(frozen=True)
class Fold:
    number: int
    start: date
    end: date  # exclusive


def rolling_folds(first: date, days: int, count: int) -> list[Fold]:
    """``count`` spans of ``days`` days, one after the other from ``first`` on."""
    if days < 1 or count < 1:
        raise ValueError("folds need at least one day and one fold")
    step = timedelta(days=days)
    return [Fold(n, first + n * step, first + (n + 1) * step) for n in range(count)]


def fold_of(folds: Sequence[Fold], day: str = "date") -> Column:
    """The fold that validates a row, null where none does."""
    number = F.lit(None).cast("int")
    for fold in folds:
        inside = (F.col(day) >= F.lit(fold.start)) & (F.col(day) < F.lit(fold.end))
        number = F.when(inside, F.lit(fold.number)).otherwise(number)
    return number


def fold_sizes(table: DataFrame, folds: Sequence[Fold], day: str = "date") -> DataFrame:
    """Per fold its origin, rows to train and to validate on, and the last day trained on; one pass."""
    facts = table.agg(
        *[
            column.alias(f"{name}{fold.number}")
            for fold in folds
            for name, column in (
                ("t", F.count_if(F.col(day) < F.lit(fold.start))),
                ("v", F.count_if((F.col(day) >= F.lit(fold.start)) & (F.col(day) < F.lit(fold.end)))),
                ("l", F.max(F.when(F.col(day) < F.lit(fold.start), F.col(day)))),
            )
        ]
    )
    rows = [
        F.struct(
            F.lit(fold.number).alias("fold"),
            F.lit(fold.start).alias("valid_start"),
            F.col(f"t{fold.number}").alias("train_rows"),
            F.col(f"v{fold.number}").alias("valid_rows"),
            F.col(f"l{fold.number}").alias("last_train_day"),
        )
        for fold in folds
    ]
    return facts.select(F.inline(F.array(*rows)))


def fold_errors(scored: DataFrame, folds: Sequence[Fold], label: str, prediction: str) -> DataFrame:
    """Error of a given prediction within each fold's span, in one pass."""
    placed = scored.withColumn("fold", fold_of(folds)).filter("fold is not null")
    return placed.groupBy("fold").agg(rmse_of(label, prediction).alias("rmse"))


@dataclass(frozen=True)
class FoldSearch:
    """``rows``: one per grid point with its mean error, ``fold_rows``: one per fold and point."""

    rows: list[dict[str, Any]]
    fold_rows: list[dict[str, Any]]

    @property
    def best(self) -> dict[str, Any]:
        return next(row for row in self.rows if row["is_best"])


def cross_validate(
    table: DataFrame,
    folds: Sequence[Fold],
    depths: Sequence[int] = forecast.DEPTHS,
    iterations: Sequence[int] = forecast.ITERATIONS,
    steps: Sequence[float] = forecast.STEPS,
    features: Sequence[str] = forecast.FEATURES,
    seed: int = forecast.SEED,
    parallelism: int = PARALLEL_FITS,
) -> FoldSearch:
    """Every grid point on every fold; the least mean error wins, ties to the first point.

    As in ``search_forecast`` each (fold, depth, step) is fitted once with the
    most iterations and its prefixes are the other points. Vectors are made
    once for all folds; parts are range filters on them. A fold without rows
    to train or to validate on raises. Give ``table`` staged.
    """
    spark = table.sparkSession
    shared_dir(spark)
    sizes = {row.fold: row for row in fold_sizes(table, folds).collect()}
    for fold in folds:
        if not sizes[fold.number].train_rows or not sizes[fold.number].valid_rows:
            raise ValueError(f"fold {fold.number} ({fold.start}) has no rows to train or to validate on")
    vectors = forecast.assembler(features).transform(table).select("date", "features", forecast.LABEL)
    ready = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    longest = max(iterations)

    def errors(point: tuple[Fold, int, float]) -> list[float]:
        fold, depth, step = point
        train = ready.filter(F.col("date") < F.lit(fold.start))
        valid = ready.filter((F.col("date") >= F.lit(fold.start)) & (F.col("date") < F.lit(fold.end)))
        trees = forecast._regressor(depth, longest, step, seed).fit(train)
        return trees.evaluateEachIteration(valid, "squared")

    try:
        points = [(fold, depth, step) for fold in folds for depth in depths for step in steps]
        found = dict(zip(points, run_each(spark, errors, points, parallelism)))
    finally:
        ready.unpersist()
    fold_rows = [
        {
            "fold": fold.number,
            "max_depth": depth,
            "max_iter": count,
            "step_size": float(step),
            "rmse": found[fold, depth, step][count - 1] ** 0.5,
        }
        for depth in depths
        for count in iterations
        for step in steps
        for fold in folds
    ]
    grid = [
        {name: part[0][name] for name in ("max_depth", "max_iter", "step_size")}
        | {"mean_rmse": sum(row["rmse"] for row in part) / len(folds)}
        for part in (fold_rows[n : n + len(folds)] for n in range(0, len(fold_rows), len(folds)))
    ]
    return FoldSearch(first_best(grid, "mean_rmse"), fold_rows)
