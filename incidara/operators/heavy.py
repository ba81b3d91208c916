"""Top keys of a table with more keys than a shuffle should carry.

A summary counts rows by a few independent hashes of the key, ``WIDTH`` buckets
each. Summaries of tasks, days or tables add up, and a key's total is never above
the smallest of its buckets. Keys that fill heavy buckets are counted exactly;
the n-th of them is a total that every winner must reach, so only keys whose
buckets all reach it are counted in the end. The result is that of counting
every key; what moves is the summary and the keys that can still win.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hashes of a key, and buckets of each: a summary has at most HASHES x WIDTH rows.
HASHES = 4
WIDTH = 1 << 16
#: Heavy buckets of each hash, per winner asked for, whose keys are counted first.
FIRST = 4


def _bucket(keys: Sequence[str], number: int, width: int) -> Column:
    # null marks go in too, as the hash itself skips nulls
    values = [part for name in keys for part in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.pmod(F.xxhash64(F.lit(number), *values), F.lit(width)).cast("int")


def summary(
    df: DataFrame, keys: Sequence[str], weight: Column, hashes: int = HASHES, width: int = WIDTH
) -> DataFrame:
    """Rows (hash, bucket, total): the summed weights of the keys in each bucket.

    Weights are whole numbers, none below zero; a null one counts as zero. Rows
    fold in the tasks, so each sends at most hashes x width of them.
    """
    buckets = F.array(
        *[F.struct(F.lit(i).alias("hash"), _bucket(keys, i, width).alias("bucket")) for i in range(hashes)]
    )
    rows = df.select(F.coalesce(weight, F.lit(0)).cast("long").alias("weight"), F.inline(buckets))
    return rows.groupBy("hash", "bucket").agg(F.sum("weight").alias("total"))


def merge_summaries(summaries: DataFrame) -> DataFrame:
    """One summary out of any number made with the same hashes and width."""
    return summaries.groupBy("hash", "bucket").agg(F.sum("total").alias("total"))


def bounds(df: DataFrame, keys: Sequence[str], merged: DataFrame, hashes: int = HASHES, width: int = WIDTH) -> DataFrame:
    """``df`` with ``at_most``: the smallest bucket of its key, no less than the key's total.

    For all but a share of about exp(-hashes) of the keys it exceeds the total by no
    more than e / width of all weights. A key that no summary saw gets 0.
    """
    names = []
    for i in range(hashes):
        of_hash = merged.filter(F.col("hash") == i).select(F.col("bucket").alias(f"_b{i}"), F.col("total").alias(f"_t{i}"))
        df = df.withColumn(f"_b{i}", _bucket(keys, i, width)).join(F.broadcast(of_hash), f"_b{i}", "left").drop(f"_b{i}")
        names.append(f"_t{i}")
    least = F.least(*[F.coalesce(F.col(name), F.lit(0)) for name in names])
    return df.withColumn("at_most", least).drop(*names)


def _kept(df: DataFrame, keys: Sequence[str], heavy: DataFrame, hashes: int, width: int) -> DataFrame:
    """Rows whose buckets are all among ``heavy``, which holds at most hashes x width rows."""
    for i in range(hashes):
        of_hash = heavy.filter(F.col("hash") == i).select(F.col("bucket").alias(f"_b{i}"))
        df = df.withColumn(f"_b{i}", _bucket(keys, i, width)).join(F.broadcast(of_hash), f"_b{i}", "left_semi")
    return df.drop(*[f"_b{i}" for i in range(hashes)])


def top_heavy(
    df: DataFrame,
    keys: Sequence[str],
    weight: Column,
    n: int,
    name: str = "total_accidents",
    merged: DataFrame | None = None,
    hashes: int = HASHES,
    width: int = WIDTH,
) -> DataFrame:
    """The ``n`` keys of largest summed weight, ties by key; the rows of a full count.

    ``merged`` is a summary of the same rows, if one is kept; else one scan makes
    it. Two more scans read keys and weight alone. Where totals are so even that
    no bucket can be ruled out, the last scan counts all keys, as a full count does.
    A null key is a key; weights as in ``summary``.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, not {n}")
    names = list(keys)
    totals = merged if merged is not None else summary(df, names, weight, hashes, width)
    # bounded by hashes x width rows, and read three times
    totals = df.sparkSession.createDataFrame(totals.toArrow())
    rows = df.select(*[F.col(f"`{key}`") for key in names], F.coalesce(weight, F.lit(0)).cast("long").alias("_weight"))
    most = Window.partitionBy("hash").orderBy(F.desc("total"), "bucket")

    def counted(heavy: DataFrame) -> DataFrame:
        found = _kept(rows, names, heavy, hashes, width).groupBy(*names).agg(F.sum("_weight").alias(name))
        return found.orderBy(F.desc(name), *names).limit(n)

    first = totals.withColumn("_place", F.row_number().over(most)).filter(F.col("_place") <= FIRST * n)
    reached, found = counted(first).agg(F.min(name), F.count("*")).first()
    floor = reached if found == n else 0
    return counted(totals.filter(F.col("total") >= floor))
