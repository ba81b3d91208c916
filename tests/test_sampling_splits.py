from __future__ import annotations

import hashlib
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from incidara.operators.sampling import chunk_of, sample_bernoulli, sample_exact_strata
from incidara.operators.splits import (
    TimeBounds,
    key_height,
    key_split_label,
    split_bounds,
    split_by_key,
    split_by_time,
    split_random,
)


def by_brute_force(rows, fraction, seed):
    strata = defaultdict(list)
    for key, stratum in rows:
        strata[stratum].append((hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key))
    return {
        (key, stratum)
        for stratum, tickets in strata.items()
        for _, key in sorted(tickets)[: round(fraction * len(tickets))]
    }


@pytest.mark.parametrize("fraction", [0.01, 0.02, 0.25, 0.9])
@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_strata_equals_brute_force(spark, fraction, partitions):
    # One stratum with many rows, a null one, and 300 of fifty rows, where a
    # share of 0.02 makes some quotas end in the wide bins.
    rows = (
        spark.range(32_000)
        .repartition(partitions)
        .withColumn(
            "part",
            F.when(F.col("id") < 14_000, 1)
            .when(F.col("id") < 17_000, F.lit(None).cast("int"))
            .otherwise((F.col("id") % 300).cast("int") + 2),
        )
    )
    drawn = sample_exact_strata(rows, ["part"], "id", fraction, seed=9)
    got = [(row.id, row.part) for row in drawn.collect()]
    assert len(got) == len(set(got))
    assert set(got) == by_brute_force([tuple(r) for r in rows.collect()], fraction, 9)


def test_exact_strata_of_nothing(spark):
    empty = spark.range(0).withColumn("part", F.lit(1))
    assert sample_exact_strata(empty, ["part"], "id", seed=1).count() == 0


def test_exact_strata_takes_everything_or_refuses(spark):
    rows = spark.range(100).withColumn("part", F.col("id") % 3)
    assert sample_exact_strata(rows, ["part"], "id", 1.0, seed=1).count() == 100
    with pytest.raises(ValueError, match="fraction"):
        sample_exact_strata(rows, ["part"], "id", 0.0, seed=1)


def test_chunks_have_the_asked_size(spark):
    sizes = [
        row["count"]
        for row in spark.range(50_000).groupBy(chunk_of("id", 50_000, 10_000)).count().collect()
    ]
    assert len(sizes) == 5 and all(9_000 < n < 11_000 for n in sizes)


def test_bernoulli_is_a_subset_of_about_the_share(spark):
    got = [row.id for row in sample_bernoulli(spark.range(100_000), seed=3).collect()]
    assert len(got) == len(set(got)) and abs(len(got) - 1000) < 5 * 1000**0.5


def test_random_split_covers_and_is_disjoint(spark):
    train, valid = split_random(spark.range(10_000))
    left, right = {r.id for r in train.collect()}, {r.id for r in valid.collect()}
    assert not left & right and len(left | right) == 10_000
    assert abs(len(left) - 8000) < 5 * (10_000 * 0.16) ** 0.5


def test_key_split_does_not_follow_the_layout(spark):
    ids = spark.range(10_000)
    first = {r.id for r in split_by_key(ids, "id")[0].collect()}
    again = {r.id for r in split_by_key(ids.repartition(7), "id")[0].collect()}
    rest = {r.id for r in split_by_key(ids, "id")[1].collect()}
    assert first == again and len(first) + len(rest) == 10_000
    low, high = ids.select(key_height("id").alias("p")).agg(F.min("p"), F.max("p")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1


@pytest.mark.parametrize("share", [0.004, 0.125, 0.996])
def test_key_split_keeps_any_share(spark, share):
    train, valid = split_by_key(spark.range(100_000), "id", share)
    n = train.count()
    assert abs(n - 100_000 * share) < 5 * (100_000 * share * (1 - share)) ** 0.5
    assert n + valid.count() == 100_000


@pytest.mark.parametrize("share", [0, 1, -0.1, 1.5])
def test_key_split_refuses_empty_parts(share):
    with pytest.raises(ValueError):
        key_split_label("id", share)


def test_null_keys_are_for_validation(spark):
    rows = spark.createDataFrame([(None,)], "id long")
    assert [r.count() for r in split_by_key(rows, "id")] == [0, 1]


def test_time_split_bounds_are_half_open(spark):
    days = [date(2020, 12, 31), date(2021, 1, 1), date(2021, 12, 31), date(2022, 1, 1), None]
    rows = spark.createDataFrame([(d, n) for n, d in enumerate(days, 1)], "date date, accident_count long")
    parts = [[r.accident_count for r in part.collect()] for part in split_by_time(rows)]
    assert parts == [[1], [2, 3], [4]]
    labels = [r[0] for r in rows.orderBy("accident_count").select(TimeBounds().label()).collect()]
    assert labels == ["train", "valid", "valid", "test", None]
    got = {r.split: (r.first_date, r.text_height) for r in split_bounds(rows).collect()}
    assert got == {"valid": (days[1], 0.95), "test": (days[3], 0.95)}
