"""Groups of cities of like weather and severity, by k-means."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from incidara.operators.panel import CITY

# Number of groups, seed, feature order.
K = 5
SEED = 42
FEATURES = ["avg_severity", "avg_temp", "avg_humidity", "avg_visibility", "avg_precip"]

#: Partitions of the city table; part of what k-means' answer depends on.
PARTITIONS = 8
MEAN_DIGITS = 9


@dataclass(frozen=True)
class Clusters:
    """``centres`` are listed by group number, in the model's feature scale."""

    model: PipelineModel
    table: DataFrame
    centres: list[list[float]]


def steady_layout(profile: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """The same rows in the same partitions in the same order on every run.

    k-means seeds its centres partition by partition, so its result follows
    the layout. Hashing by city into a fixed number of partitions, sorted
    within, makes the layout a function of the data. Means are rounded so that summation order cannot move a row.
    """
    rounded = {name: F.round(name, MEAN_DIGITS) for name in FEATURES}
    return (
        profile.withColumns(rounded).repartition(partitions, *keys).sortWithinPartitions(*keys)
    )


def cluster_cities(
    profile: DataFrame,
    keys: Sequence[str] = CITY,
    k: int = K,
    seed: int = SEED,
    scale: bool = False,
    partitions: int = PARTITIONS,
) -> Clusters:
    """Assign every city to one of ``k`` groups.

    Groups are numbered by centre (temperature, then humidity, ...), not by
    the order k-means found them in. A city without a value in some measure
    raises. Give ``profile`` staged: the fit reads it many times. Another
    number of ``partitions`` may give other groups.
    """
    city = steady_layout(profile, keys, partitions)
    prepare = [VectorAssembler(inputCols=FEATURES, outputCol="features")]
    column = "features"
    if scale:
        column = "scaled"
        prepare.append(
            StandardScaler(inputCol="features", outputCol=column, withMean=True, withStd=True).fit(
                prepare[0].transform(city)
            )
        )
    ready = PipelineModel(stages=prepare).transform(city).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        means = KMeans(k=k, seed=seed, featuresCol=column).fit(ready)
    finally:
        ready.unpersist()

    # Temperature first, then humidity, severity, visibility, precipitation.
    order = [FEATURES.index(name) for name in ("avg_temp", "avg_humidity", *FEATURES)]
    centres = [list(map(float, centre)) for centre in means.clusterCenters()]
    ranked = sorted(range(len(centres)), key=lambda n: [centres[n][p] for p in order])
    number = F.array(*[F.lit(ranked.index(n)) for n in range(len(centres))])

    model = PipelineModel(stages=[*prepare, means])
    scored = model.transform(city).withColumn("cluster", F.get(number, F.col("prediction")))
    table = scored.select(*keys, *FEATURES, "cluster")
    return Clusters(model, table, [centres[n] for n in ranked])


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Mean of the city means per group; every city weighs the same."""
    return (
        clustered.groupBy("cluster")
        .agg(
            F.avg("avg_temp").alias("mean_temp"),
            F.avg("avg_humidity").alias("mean_humidity"),
            F.avg("avg_severity").alias("mean_severity"),
            F.avg("avg_visibility").alias("mean_visibility"),
            F.avg("avg_precip").alias("mean_precip"),
        )
        .orderBy("cluster")
    )
