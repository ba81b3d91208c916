"""Incident duration with a decision tree on hour, severity, state, distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame

from incidara.models.metrics import PARALLEL_FITS
from incidara.models.trees import DEPTHS, MIN_INSTANCES, TreeSearch, search_tree

LABEL = "duration_minutes"

# Categorical columns, feature order, bins.
CATEGORIES = ["severity", "state"]
FEATURES = ["hour", "severity_idx", "state_idx", "distance"]
BINS = 128


def fit_index(df: DataFrame, cols: Sequence[str] = CATEGORIES) -> StringIndexerModel:
    """Index by frequency (ties by name), all columns in one pass.

    Values not seen in fitting, and nulls, get the next free number. Meant for
    columns of few values (levels, states): all labels go to the driver.
    """
    names = list(cols)
    return StringIndexer(
        inputCols=names, outputCols=[f"{name}_idx" for name in names], handleInvalid="keep"
    ).fit(df)


def bins_for(index: StringIndexerModel, least: int = BINS) -> int:
    """A categorical feature needs a bin per label and one for the unseen."""
    return max(least, *[len(labels) + 1 for labels in index.labelsArray])


def search_duration_tree(
    train: DataFrame,
    valid: DataFrame,
    depths: Sequence[int] = DEPTHS,
    min_instances: Sequence[int] = MIN_INSTANCES,
    parallelism: int = PARALLEL_FITS,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    features: Sequence[str] = FEATURES,
) -> TreeSearch:
    """Indexers see the training part only. Give both parts staged."""
    index = fit_index(train)
    vectors = VectorAssembler(inputCols=list(features), outputCol="features")
    return search_tree(
        [index, vectors],
        train,
        valid,
        LABEL,
        depths,
        min_instances,
        max_bins=bins_for(index),
        parallelism=parallelism,
        storage=storage,
    )
