from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from incidara.operators.quality import (
    deduplicate,
    drop_nulls,
    duplicate_audit,
    impute_mean,
    nonnull_profile,
    present,
    row_counts,
)


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [(1, 1.0, 1, "a"), (2, None, None, "b"), (3, float("nan"), 4, None)],
        "id int, `d(x)` double, i int, s string",
    )


def test_drop_any_treats_nan_as_missing(gaps):
    assert [row.id for row in drop_nulls(gaps).collect()] == [1]
    assert {tuple(r) for r in drop_nulls(gaps).collect()} == {tuple(r) for r in gaps.na.drop().collect()}


def test_drop_named(gaps):
    assert [row.id for row in drop_nulls(gaps, ["i"]).orderBy("id").collect()] == [1, 3]


def test_profile_counts_nan_as_a_value(gaps):
    got = {row.column_name: row.non_null for row in nonnull_profile(gaps).collect()}
    assert got == {"id": 3, "d(x)": 2, "i": 2, "s": 2}


def test_row_counts(gaps):
    got = {
        row["stage"]: row["rows"]
        for row in row_counts(gaps, {"all": F.lit(True), "whole": present(gaps)}).collect()
    }
    assert got == {"all": 3, "whole": 1}


def test_impute_mean(spark):
    rows = spark.createDataFrame([(1.0, 1), (None, None), (float("nan"), 4)], "d double, i int")
    got = sorted(tuple(row) for row in impute_mean(rows, ["d", "i"]).collect())
    assert got == [(1.0, 1), (1.0, 2), (1.0, 4)]  # the integer mean 2.5 is cut to 2


def test_impute_without_any_value_raises(spark):
    rows = spark.createDataFrame([(None,), (None,)], "d double")
    with pytest.raises(Exception, match="(?i)surrogate|null|missing"):
        impute_mean(rows, ["d"]).collect()


def test_duplicates(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "s string, n int")
    assert tuple(duplicate_audit(rows).first()) == (3, 2)
    assert tuple(duplicate_audit(rows.limit(0)).first()) == (0, 0)
    swapped = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "s string, t string")
    for frame in (rows, rows.limit(0), swapped):
        assert duplicate_audit(frame, by_hash=True).first() == duplicate_audit(frame).first()
    assert deduplicate(rows).count() == 2
    assert deduplicate(rows, ["s"]).count() == 2
