"""Severity classes with a decision tree, and measures of any classifier.

Measures come from the confusion table, one row per pair of classes, so the
scored rows are read once and fold in the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

LABEL = "severity"
NUMBERS = ["hour", "distance"]
CATEGORIES = ["state"]
DEPTH = 5


def fit_severity(
    train: DataFrame,
    depth: int = DEPTH,
    numbers: Sequence[str] = NUMBERS,
    categories: Sequence[str] = CATEGORIES,
    label: str = LABEL,
    min_instances: int = 1,
) -> PipelineModel:
    """Index and one-hot stages, assembler, tree, and the way back from index to class.

    Classes and categories are indexed by frequency, ties by name; a category
    not seen in training, or null, has a slot of its own. Rows to score need a
    label column, whose value may be unseen or null. The model adds ``predicted`` (a class) and ``probability``. Meant for
    categories of few values: all labels go to the driver.
    """
    classes = StringIndexer(inputCol=label, outputCol="_class", handleInvalid="keep").fit(train)
    stages = [classes]
    if categories:
        indexed = [f"{name}_idx" for name in categories]
        hot = [f"{name}_hot" for name in categories]
        stages.append(StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep", dropLast=False))
    else:
        hot = []
    stages += [
        VectorAssembler(inputCols=[*numbers, *hot], outputCol="features"),
        DecisionTreeClassifier(
            labelCol="_class", featuresCol="features", predictionCol="_predicted", maxDepth=depth, minInstancesPerNode=min_instances
        ),
        IndexToString(inputCol="_predicted", outputCol="predicted", labels=list(classes.labels)),
    ]
    return Pipeline(stages=stages).fit(train)


def confusion(scored: DataFrame, actual: str = LABEL, predicted: str = "predicted") -> DataFrame:
    """Rows per pair of actual and predicted class."""
    return scored.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("rows")
    )


def class_measures(pairs: DataFrame) -> DataFrame:
    """Per class its rows, precision, recall and F1, out of a confusion table, in one aggregate.

    Precision of a class never predicted, and recall of one that never occurs, is null; F1 is
    then null too. Null classes are left out.
    """
    roles = F.array(
        F.struct(F.col("actual").alias("class"), F.col("rows").alias("is"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("is"), F.col("rows").alias("said")),
    )
    hit = F.when((F.col("actual") == F.col("predicted")) & (F.col("r.is") > 0), F.col("r.is"))
    sums = (
        pairs.select("actual", "predicted", F.explode(roles).alias("r"))
        .filter("r.class is not null")
        .groupBy("r.class")
        .agg(F.sum("r.is").alias("rows"), F.sum("r.said").alias("said"), F.coalesce(F.sum(hit), F.lit(0)).alias("hits"))
    )
    precision = F.try_divide(F.col("hits"), F.col("said"))
    recall = F.try_divide(F.col("hits"), F.col("rows"))
    f1 = F.when(precision.isNotNull() & recall.isNotNull(), F.try_divide(2 * F.col("hits"), F.col("rows") + F.col("said")))
    return sums.select("class", "rows", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))
