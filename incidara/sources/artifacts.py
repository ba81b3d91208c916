"""Readers of the small result files: importances and the cluster profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from incidara.schema import CLUSTER_PROFILE, IMPORTANCES


def read_importances(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IMPORTANCES).csv(path, header=True)


def read_cluster_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLUSTER_PROFILE).csv(path, header=True)


def cluster_by_id(profile: DataFrame, cluster: int) -> DataFrame:
    return profile.filter(F.col("Cluster") == cluster)
