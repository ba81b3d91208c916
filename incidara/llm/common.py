"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import gc
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows and bytes that a Python worker holds at once; long texts make the bytes count.
BATCH_ROWS = 1024
BATCH_BYTES = 4 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for texts of many megabytes beside each other."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def map_rows(
    df: DataFrame, schema: str, each: Callable[[Iterator[tuple]], Iterator[tuple]]
) -> DataFrame:
    """Run ``each`` over the rows (as tuples) of every partition, by Arrow batches.

    ``each`` takes an iterator of rows and yields rows of ``schema``; it may keep
    state between rows of one partition.
    """
    spark = df.sparkSession
    small_batches(spark)
    arrow = _arrow_schema(spark, schema)

    def run(batches):
        give_back()

        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        held, size = [], 0
        for row in each(rows()):
            held.append(row)
            size += sum(len(v) if isinstance(v, (str, bytes)) else 8 for v in row)
            if len(held) >= 4 * BATCH_ROWS or size >= BATCH_BYTES:
                yield _batch(held, arrow)
                held, size = [], 0
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return to the system what an earlier task left free in a worker that is used again."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def beside_helpers(operate: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return the columns of their first argument.

    Their helper columns begin with two underscores; columns of the table that do
    so too go by other names while ``operate`` builds its result.
    """

    @functools.wraps(operate)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        used = {c.lower() for c in docs.columns}
        spare = (n for n in map("aside_{}".format, itertools.count()) if n not in used)
        aside = {c: next(spare) for c in docs.columns if c.startswith("__")}
        if not aside:
            return operate(docs, *args, **kwargs)
        out = operate(docs.withColumnsRenamed(aside), *args, **kwargs)
        return out.withColumnsRenamed({new: old for old, new in aside.items()})

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


