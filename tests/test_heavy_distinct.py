from __future__ import annotations

import random
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from incidara.operators import distinct_state, heavy, panel
from incidara.session import fresh_path, stage

# top keys ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def busy(spark):
    """A third of the rows in one key, some keys that tie, many rare ones, null keys and ids."""
    rng = random.Random(5)
    keys = ["hot"] * 2000 + [f"city {n}" for n in range(30) for _ in range(40)]
    keys += [f"rare {rng.randint(0, 900)}" for _ in range(2500)] + [None] * 55 + ["only nulls"] * 70
    rows = [(None if key == "only nulls" else n, key, key and key[:4]) for n, key in enumerate(keys)]
    rng.shuffle(rows)
    return stage(spark.createDataFrame(rows, "id long, city string, state string").repartition(7), "busy")


@pytest.mark.parametrize("n, width", [(1, heavy.WIDTH), (20, heavy.WIDTH), (20, 256), (5, 8), (5000, 1)])
def test_heavy_keys_are_those_of_a_full_count(busy, n, width):
    keys = ["city"] if n == 5 else ["state", "city"]
    got = heavy.top_heavy(busy, keys, F.col("id").isNotNull().cast("int"), n, width=width)
    assert got.collect() == panel.top_cities(busy, n, keys).collect()


def test_heavy_keys_of_sums_and_of_nothing(spark, busy):
    sums = heavy.top_heavy(busy, ["city"], F.col("id") % 5, 4, "total", width=64).collect()
    whole = busy.groupBy("city").agg(F.sum(F.coalesce(F.col("id") % 5, F.lit(0))).alias("total"))
    assert sums == whole.orderBy(F.desc("total"), "city").limit(4).collect()
    assert heavy.top_heavy(busy.limit(0), ["city"], F.lit(1), 3).collect() == []
    with pytest.raises(ValueError):
        heavy.top_heavy(busy, ["city"], F.lit(1), 0)


def test_summaries_of_parts_merge_to_that_of_the_whole(busy):
    one = F.lit(1)
    parts = [heavy.summary(busy.filter(F.pmod("id", F.lit(3)).eqNullSafe(n)), ["city"], one) for n in (0, 1, 2, None)]
    merged = heavy.merge_summaries(parts[0].union(parts[1]).union(parts[2]).union(parts[3]))
    assert sorted(merged.collect()) == sorted(heavy.summary(busy, ["city"], one).collect())
    kept = heavy.top_heavy(busy, ["city"], one, 3, merged=merged)
    assert [r.city for r in kept.collect()] == ["hot", "only nulls", None]


def test_a_summary_bounds_every_total(busy):
    narrow = heavy.summary(busy, ["city"], F.lit(1), width=64)
    assert narrow.count() <= heavy.HASHES * 64
    totals = busy.groupBy("city").agg(F.count("*").alias("total"))
    rows = heavy.bounds(totals, ["city"], narrow, width=64).collect()
    assert len(rows) == totals.count() and all(r.at_most >= r.total for r in rows)
    over = sum(r.at_most - r.total > 2.72 / 64 * busy.count() for r in rows)
    assert over <= len(rows) * 2.72 ** -heavy.HASHES


def test_only_keys_that_can_win_are_shuffled(busy):
    # with the registered width rare keys share a bucket of every hash with no winner
    totals = heavy.summary(busy, ["city"], F.lit(1))
    left = heavy._kept(busy, ["city"], totals.filter("total >= 40"), heavy.HASHES, heavy.WIDTH)
    counts = Counter(r.city for r in busy.collect())
    assert {r.city for r in left.select("city").distinct().collect()} == {c for c, n in counts.items() if n >= 40}


# distinct counts ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def days(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 60_000), rng.choice("abc"), date(2020, 1 + n % 3, 1 + n % 25)) for n in range(60_000)]
    rows += [(None, "a", date(2020, 1, 1)), (7, None, None)] + [(1, "a", date(2020, 2, 2))] * 20_000
    return stage(spark.createDataFrame(rows, "id long, city string, date date"), "days")


def states_of(df):
    return distinct_state.distinct_states(
        df, F.col("date"), {"id": F.col("id"), "city": F.col("city"), "row": distinct_state.row_value(df)}
    )


def exact(df):
    row = df.agg(F.count_distinct("id"), F.count_distinct("city"), F.count("id"), F.count("city"), F.count("*")).first()
    return {"id": (row[0], row[2]), "city": (row[1], row[3]), "row": (df.distinct().count(), row[4])}


def test_united_sketches_hold_their_error(spark, days):
    path = fresh_path(spark, "distinct")
    half = F.coalesce(F.col("id") % 2, F.lit(0))
    for n in (0, 1):
        distinct_state.land_distinct(states_of(days.filter(half == n)), path, f"batch {n}")
    wide = 3 * distinct_state.standard_error()
    ranges = [(None, None), (date(2020, 2, 1), None), (date(2020, 1, 20), date(2020, 2, 3)), (date(2020, 3, 4), date(2020, 3, 4))]
    for first, last in ranges:
        inside = F.lit(True)
        if first:
            inside = inside & (F.col("date") >= F.lit(first))
        if last:
            inside = inside & (F.col("date") <= F.lit(last))
        want = exact(days.filter(inside))
        got = distinct_state.united(distinct_state.read_distinct(spark, path, first, last)).collect()
        assert {r.measure for r in got} == set(want)
        for r in got:
            distinct, rows = want[r.measure]
            assert r.rows == rows
            assert abs(r["distinct"] - distinct) <= wide * distinct
            assert r.at_least <= distinct <= r.at_most


def test_landing_distinct_states_reads_and_touches_its_own_months_alone(spark, days):
    path = fresh_path(spark, "distinct")
    distinct_state.land_distinct(states_of(days), path, "first")
    before = {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    late = states_of(days.filter(F.col("date") == F.lit(date(2020, 2, 2))))
    assert path not in late._jdf.queryExecution().toString()
    distinct_state.land_distinct(late, path, "late")
    after = {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    assert before.items() <= after.items()
    assert all("month=2020-02-01/batch=late" in name for name in after.keys() - before.keys())
    once = distinct_state.united(distinct_state.read_distinct(spark, path)).collect()
    distinct_state.land_distinct(late, path, "late")  # again: replaced, not added
    assert sorted(distinct_state.united(distinct_state.read_distinct(spark, path)).collect()) == sorted(once)


def test_row_values_tell_nulls_apart(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("a", None), (None, None)], "x string, y string")
    values = [r[0] for r in rows.select(distinct_state.row_value(rows)).collect()]
    assert values[1] == values[2] and len(set(values)) == 3
