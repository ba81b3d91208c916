"""Duration trees on folded cells instead of rows.

A variance tree sees of the rows with equal features only how many there are
and what their labels add up to: within such a cell no cut can part them, so
the spread inside it is the same before and after any cut. Distances are cut
into bins first, rows fold to one cell per (hour, severity, state, bin), and
every fit reads the cells with their row counts as weights. A table of any
size becomes at most hours x severities x states x bins cells, in one shuffle
that folds in the tasks; it is all that fits keep in memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import inf

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame, functions as F

from incidara.models.duration import BINS, CATEGORIES, LABEL
from incidara.models.metrics import PARALLEL_FITS, first_best, run_each
from incidara.models.trees import DEPTHS, MIN_INSTANCES, TreeSearch
from incidara.session import stage

BIN = "distance_bin"
CELL = ["hour", *CATEGORIES, BIN]
FEATURES = ["hour", *[f"{name}_idx" for name in CATEGORIES], BIN]

#: Of percentile_approx: a cut's rank is off by at most rows / ACCURACY.
ACCURACY = 100_000


def distance_bins(rows: DataFrame, bins: int = BINS, column: str = "distance") -> Bucketizer:
    """Cut distances into at most ``bins`` bins of about equal row counts.

    A value's bin is the number of cuts that don't exceed it. Cuts are values
    of the table; where it has fewer different values than bins, each has a
    bin of its own.
    """
    marks = [n / bins for n in range(1, bins)]
    cuts = rows.agg(F.percentile_approx(column, marks, ACCURACY)).first()[0]
    if cuts is None:
        raise ValueError(f"no {column} to cut into bins; is the training part empty?")
    return Bucketizer(splits=[-inf, *sorted(set(cuts)), inf], inputCol=column, outputCol=BIN)


def fold(rows: DataFrame, cutter: Transformer, label: str = LABEL) -> DataFrame:
    """Cells with their rows, label sum and sum of squared labels."""
    return (
        cutter.transform(rows)
        .groupBy(*CELL)
        .agg(
            F.count("*").alias("rows"),
            F.sum(label).alias("label_sum"),
            F.sum(F.col(label) * F.col(label)).alias("label_squares"),
        )
    )


def index_from_cells(cells: DataFrame, cols: Sequence[str] = CATEGORIES) -> list[StringIndexerModel]:
    """An indexer per column with the labels of :func:`duration.fit_index`: by row count, ties by name."""
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("label")) for c in cols]))
    counted = (
        cells.select(named.alias("cell"), "rows")
        .filter("cell.label is not null")
        .groupBy("cell.name", "cell.label")
        .agg(F.sum("rows").alias("n"))
        .orderBy(F.desc("n"), "label")
        .collect()
    )
    return [
        StringIndexerModel.from_labels(
            [row.label for row in counted if row.name == c], inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"
        )
        for c in cols
    ]


def rmse_of_cells(trees: Sequence[DecisionTreeRegressionModel], cells: DataFrame) -> list[float]:
    """Errors of several trees over the rows behind the cells, in one pass over the cells."""
    scored, names = cells, [f"_prediction_{n}" for n in range(len(trees))]
    for tree, name in zip(trees, names):
        scored = tree.copy({tree.predictionCol: name}).transform(scored)

    def error(name: str):
        p = F.col(name)
        squared = F.sum(F.col("label_squares") - 2 * p * F.col("label_sum") + p * p * F.col("rows"))
        return F.sqrt(F.greatest(squared, F.lit(0.0)) / F.sum("rows")).alias(name)

    row = scored.agg(*map(error, names)).first()
    return [float("nan") if row[name] is None else row[name] for name in names]


def search_folded_tree(
    train: DataFrame,
    valid: DataFrame,
    depths: Sequence[int] = DEPTHS,
    min_instances: Sequence[int] = MIN_INSTANCES,
    parallelism: int = PARALLEL_FITS,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    features: Sequence[str] = FEATURES,
    bins: int = BINS,
) -> TreeSearch:
    """Every grid point of the duration tree on cells; the least validation error wins.

    The rows are read twice for the cuts and the fold of the training part and
    once for the validation part; fits and scores read cells. The rule of
    ``min_instances`` rows per leaf becomes a share of the total weight, set
    half a row lower so that rounding can't turn it. The model takes rows.
    """
    spark = train.sparkSession
    cutter = distance_bins(train, bins)
    folded = [stage(fold(part, cutter), "cells") for part in (train, valid)]
    indexes = index_from_cells(folded[0])
    vectors = VectorAssembler(inputCols=list(features), outputCol="features")
    prepare = PipelineModel(stages=[*indexes, vectors])
    # A categorical feature needs a bin per label and one for the unseen.
    most = max(BINS, bins, *[len(index.labels) + 1 for index in indexes])

    def ready(cells: DataFrame) -> DataFrame:
        table = prepare.transform(cells).select(
            "features", "rows", "label_sum", "label_squares",
            (F.col("label_sum") / F.col("rows")).alias("label"),
            F.col("rows").cast("double").alias("weight"),
        )
        return table.persist(storage) if storage else table

    train_cells, valid_cells = map(ready, folded)
    total = folded[0].agg(F.sum("rows")).first()[0]

    def fit(point: tuple[int, int]) -> DecisionTreeRegressionModel:
        depth, smallest = point
        tree = DecisionTreeRegressor(
            labelCol="label",
            featuresCol="features",
            weightCol="weight",
            maxDepth=depth,
            minInstancesPerNode=1,
            # A share of one half or more allows no cut at all; below that MLlib takes it.
            minWeightFractionPerNode=min((smallest - 0.5) / total, 0.499999),
            maxBins=most,
        )
        return tree.fit(train_cells)

    try:
        points = [(depth, smallest) for depth in depths for smallest in min_instances]
        trees = run_each(spark, fit, points, parallelism)
        errors = list(zip(rmse_of_cells(trees, train_cells), rmse_of_cells(trees, valid_cells)))
    finally:
        if storage:
            train_cells.unpersist()
            valid_cells.unpersist()
    rows = first_best(
        [
            {"max_depth": depth, "min_instances": smallest, "training_rmse": on_train, "valid_rmse": on_valid}
            for (depth, smallest), (on_train, on_valid) in zip(points, errors)
        ],
        "valid_rmse",
    )
    best = next(n for n, row in enumerate(rows) if row["is_best"])
    return TreeSearch(PipelineModel(stages=[*indexes, cutter, vectors, trees[best]]), rows)
