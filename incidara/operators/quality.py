"""Null handling, audits and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame, functions as F, types as T


def present(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """True where every named column (all by default) holds a value.

    NaN counts as missing. Written as single ``is not null`` tests, which
    Spark hands to the Parquet reader; ``na.drop`` is not handed down.
    """
    types = {field.name: field.dataType for field in df.schema.fields}

    def holds(name: str) -> Column:
        column = F.col(f"`{name}`")
        if isinstance(types[name], (T.DoubleType, T.FloatType)):
            return column.isNotNull() & ~F.isnan(column)
        return column.isNotNull()

    return reduce(Column.__and__, [holds(name) for name in cols or df.columns])


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any column, or in the named ones.

    Without ``cols`` columns that are not used later decide too, so the scan
    reads the whole table; name the columns to let it read only those.
    """
    return df.filter(present(df, cols))


def nonnull_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many rows are not null. One pass, one row shuffled per task."""
    counts = df.agg(*[F.count(f"`{name}`").alias(name) for name in df.columns])
    return counts.unpivot([], [F.col(f"`{name}`") for name in df.columns], "column_name", "non_null")


def row_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows that pass each named condition, all counted in one pass."""
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in stages.items()])
    return counts.unpivot([], [F.col(f"`{name}`") for name in stages], "stage", "rows")


def _row_hash(df: DataFrame, seed: int) -> Column:
    """64-bit hash of a row. Null marks go in too: the hash itself skips nulls,
    so that (a, null) and (null, a) would fall together."""
    values = [F.col(f"`{name}`") for name in df.columns]
    return F.xxhash64(F.lit(seed), *values, *[value.isNull() for value in values])


def duplicate_audit(df: DataFrame, by_hash: bool = False) -> DataFrame:
    """Total and distinct rows in one scan and one shuffle.

    Equal rows fold inside each task before the shuffle, so a row that fills
    a third of the table costs one record per task. The shuffle moves whole
    rows; ``by_hash`` moves two 64-bit hashes instead, for wide tables, where
    10^12 rows have less than one chance in 10^13 of being off by one.
    """
    keys = (
        [_row_hash(df, seed).alias(f"_hash{seed}") for seed in (1, 2)]
        if by_hash
        else [F.col(f"`{name}`") for name in df.columns]
    )
    folded = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return folded.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_rows")
    )


def deduplicate(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row of each group of equal rows (equal in ``cols``, if named)."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill missing values (null or NaN) of ``cols`` with the column mean.

    Fitting is one aggregation over all columns; the means travel as
    constants, so filling needs no shuffle. A column with no value at all
    raises; an integer column gets its mean cut to a whole number.
    """
    names = list(cols)
    imputer = Imputer(strategy="mean", inputCols=names, outputCols=names)
    return imputer.fit(df).transform(df)


def profile_and_means(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, float | int]]:
    """``nonnull_profile`` of all columns and the means of ``cols``, in one pass.

    Means leave out null and NaN; that of an integer column is cut to a whole
    number; a column with no value at all raises.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    counts = [F.count(f"`{name}`").alias(f"n{i}") for i, name in enumerate(df.columns)]
    held = [F.when(present(df, [name]), F.col(f"`{name}`")) for name in cols]
    row = df.agg(*counts, *[F.avg(column).alias(f"m{i}") for i, column in enumerate(held)]).first()
    empty = [name for i, name in enumerate(cols) if row[f"m{i}"] is None]
    if empty:
        raise ValueError(f"no value to take a mean of in {', '.join(empty)}")
    means = {
        name: int(row[f"m{i}"]) if isinstance(types[name], T.IntegralType) else row[f"m{i}"]
        for i, name in enumerate(cols)
    }
    rows = [(name, row[f"n{i}"]) for i, name in enumerate(df.columns)]
    return df.sparkSession.createDataFrame(rows, "column_name string, non_null long"), means


def fill_means(df: DataFrame, means: Mapping[str, float | int]) -> DataFrame:
    """Missing values (null or NaN) of the named columns filled with the given numbers."""
    return df.withColumns(
        {
            name: F.when(present(df, [name]), F.col(f"`{name}`")).otherwise(F.lit(mean))
            for name, mean in means.items()
        }
    )
