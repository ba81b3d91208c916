"""Session settings, the shared folder, and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the results depend on (UTC) and AQE.

    Executors, memory and the shuffle width belong to ``spark-submit``; give
    them in ``conf`` (dots written as ``__``) only for local runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    pin_time_zone(spark)
    return spark


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Hours and dates are read off in UTC, whatever the machine's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall
    back to a temporary folder; it then serves the whole session.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="incidara-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several jobs follow (grid search, k-means): a lost executor
    then costs a re-read of this small table, not of the raw incidents, and
    the planner knows its true size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
