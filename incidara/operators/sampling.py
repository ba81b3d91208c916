"""Random samples: by coin toss, and of exact size within strata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Share taken, and rows per chunk it is taken from.
FRACTION = 0.01
CHUNK_ROWS = 100_000

BINS = 1024  # bins of the tickets below SPREAD times the sampled share
SPREAD = 4


def sample_bernoulli(df: DataFrame, fraction: float = FRACTION, *, seed: int) -> DataFrame:
    """Each row by its own coin toss: no shuffle, size only approximate."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _ticket(key: str, seed: int) -> Column:
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))


def _height(ticket: Column) -> Column:
    """The ticket as a number in [0, 1), from its first 32 bits."""
    return F.conv(F.substring(ticket, 1, 8), 16, 10).cast("double") / 2.0**32


def sample_by_key(
    df: DataFrame, key: str, fraction: float = FRACTION, *, seed: int
) -> DataFrame:
    """A coin toss fixed by seed and row id: no shuffle, approximate size, and
    the same rows on every run, however the table is partitioned."""
    return df.filter(_height(_ticket(key, seed)) < fraction)


def chunk_of(key: str, rows: int, chunk_rows: int = CHUNK_ROWS) -> Column:
    """A chunk number so that ``rows`` rows fall into chunks of about
    ``chunk_rows``, by hash of the key instead of file order."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows // chunk_rows))))


def sample_exact_strata(
    df: DataFrame, strata: Sequence[str], key: str, fraction: float = FRACTION, *, seed: int
) -> DataFrame:
    """Exactly ``round(fraction * rows)`` rows of every stratum, halves to even.

    Every row draws a ticket, the md5 of seed and ``key``, and the lowest
    tickets of a stratum win. ``key`` is a row id; rows that share one share
    their ticket. Sorting a stratum would put a large one into a single task.
    Instead tickets are counted in bins: 1,024 narrow ones for tickets up to
    four times the share, where the quota of all but tiny strata ends, then
    bins of doubling width. Bins below the quota win whole, and only the bin
    in which the quota ends is ranked.

    The counts hold some 1,030 rows per stratum. Rows above the highest bin
    any stratum needs are dropped before the join, which is on (stratum,
    bin): narrow bins spread evenly, and where tiny strata make a wide bin of
    a large one pass the filter, AQE splits it (the ranking that follows has
    a shuffle of its own, over the rows of quota bins only).
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction must be above 0 and at most 1, not {fraction}")
    names = list(strata)
    height = _height(F.col("_ticket"))
    spread = height / (SPREAD * fraction)  # 1.0 where the narrow bins end
    number = F.when(spread < 1, F.floor(spread * BINS)).otherwise(F.floor(F.log2(spread)) + BINS)
    tickets = df.withColumn("_ticket", _ticket(key, seed)).withColumn("_bin", number)

    whole = Window.partitionBy(*names)
    below = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    quotas = (
        tickets.groupBy(*names, "_bin")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(below), F.lit(0)))
        .withColumn("_quota", F.bround(F.lit(fraction) * F.sum("_rows").over(whole)))
        .filter("_before < _quota")
        .select(*names, "_bin", "_rows", (F.col("_quota") - F.col("_before")).alias("_left"))
    )
    top = quotas.agg(F.max("_bin").alias("top")).scalar()
    candidates = tickets.filter(F.col("_bin") <= top).alias("c")
    same = reduce(
        Column.__and__,
        [F.col(f"c.{name}").eqNullSafe(F.col(f"q.{name}")) for name in [*names, "_bin"]],
    )
    within = candidates.join(quotas.alias("q"), same).select("c.*", "q._left", "q._rows")
    whole_bins = within.filter("_rows <= _left").select(*df.columns)
    ranked = (
        within.filter("_rows > _left")
        .withColumn(
            "_rank",
            F.row_number().over(Window.partitionBy(*names, "_bin").orderBy("_ticket", key)),
        )
    )
    return whole_bins.union(ranked.filter("_rank <= _left").select(*df.columns))
