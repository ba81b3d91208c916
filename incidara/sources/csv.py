"""CSV readers. Files stay splittable: no multi-line records, no driver reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from incidara.functions import parse_double, parse_int, parse_timestamp
from incidara.operators.quality import drop_nulls
from incidara.schema import INCIDENT_COLUMNS


def read_typed(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """CSV with a known schema, one pass; ``header=False`` for bare files."""
    return spark.read.schema(schema).csv(path, header=header)


def read_inferred(
    spark: SparkSession, path: str, sampling_ratio: float | None = None
) -> DataFrame:
    """CSV with inferred types. Costs one more pass over the sampled share."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling_ratio)


def read_strings(
    spark: SparkSession, path: str, names: Sequence[str] | None = None
) -> DataFrame:
    """CSV with every column as string; ``names`` for a file without header."""
    if names is None:
        return spark.read.csv(path, header=True, inferSchema=False)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return read_typed(spark, path, schema, header=False)


def _typed(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return parse_timestamp(column)
    if isinstance(kind, T.DoubleType):
        return parse_double(column)
    if isinstance(kind, T.IntegerType):
        return parse_int(column)
    return column


def as_published(df: DataFrame) -> DataFrame:
    """Every column as string, known ones under their published names.

    Names match without regard to case, published or as used here. Columns
    that are not known keep their own names.
    """
    known = {}
    for original, name, _ in INCIDENT_COLUMNS:
        known[original.lower()] = known[name.lower()] = original
    return df.select(
        *[F.col(f"`{c}`").cast("string").alias(known.get(c.lower(), c)) for c in df.columns]
    )


def require_columns(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """``raw`` itself; raises, naming them, if it lacks columns of ``names``."""
    there = {c.lower() for c in raw.columns}
    absent = [name for name in names if name.lower() not in there]
    if absent:
        raise ValueError(f"the incident table has no column {', '.join(absent)}")
    return raw


def typed_incidents(
    raw: DataFrame, any_null_drop: bool = False, keep_rest: bool = True
) -> DataFrame:
    """An all-string table with its known columns renamed and typed leniently.

    A bad value becomes null. ``keep_rest`` keeps all other columns, as
    strings. ``any_null_drop`` first drops records with a missing value in any
    column of the table, used here or not, which means that all are read.
    """
    raw = as_published(raw)
    if any_null_drop:
        raw = drop_nulls(raw)
    kinds = {original: (name, kind) for original, name, kind in INCIDENT_COLUMNS}
    chosen = []
    for column in raw.columns:
        if column in kinds:
            name, kind = kinds[column]
            chosen.append(_typed(column, kind).alias(name))
        elif keep_rest:
            chosen.append(F.col(f"`{column}`"))
    return raw.select(*chosen)


def read_incidents(
    spark: SparkSession,
    path: str,
    names: Sequence[str] | None = None,
    any_null_drop: bool = False,
    keep_rest: bool = False,
) -> DataFrame:
    """The known columns of an incident CSV, typed, and on request the others; see
    ``typed_incidents``. Without the others only used columns are scanned."""
    return typed_incidents(read_strings(spark, path, names), any_null_drop, keep_rest)


def read_table_strings(
    spark: SparkSession, path: str, names: Sequence[str] | None = None
) -> DataFrame:
    """A raw, cleaned or landed incident table, CSV or Parquet, as ``as_published``.

    A folder with Parquet files in it is Parquet; the landing's own year
    column is left out.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )
    if files.isEmpty():
        return as_published(read_strings(spark, path, names))
    return as_published(spark.read.parquet(path).drop("start_year"))
