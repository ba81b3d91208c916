from __future__ import annotations

import math
import random
from datetime import date
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from incidara.models import cells, duration, grouping
from incidara.models.trees import search_tree
from incidara.operators import panel, panel_state
from incidara.session import fresh_path, stage

# panel states ----------------------------------------------------------------------


def incidents(spark, rows):
    named = "id long, city string, date date, temperature_f double, humidity_pct double, visibility_mi double, precipitation_in double, severity int"
    return spark.createDataFrame([(n, c, d, t, t, None, t / 3 if t else None, n % 4) for n, (c, d, t) in enumerate(rows)], named)


@pytest.fixture(scope="module")
def two_months(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), date(2020, 1 + n % 2, 1 + n % 28), rng.choice([None, 1.1, 2.7, -3.3])) for n in range(400)]
    rows += [(None, date(2020, 1, 1), 1.0), ("a", None, 1.0)]
    return stage(incidents(spark, rows), "incidents")


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_landed_panel_equals_the_rebuilt_one(spark, two_months):
    path = fresh_path(spark, "states")
    third = F.col("id") % 3
    for n in (0, 1, 2):
        panel_state.land_incidents(two_months.filter(third == n), path, f"batch {n}")
    landed = panel_state.panel_from_states(panel_state.read_states(spark, path))
    whole = panel.city_day_panel(two_months, exact_scale=panel_state.SCALE)
    assert sorted(landed.collect()) == sorted(whole.collect())
    profile = panel.profile_from_rollup(panel_state.rollup_from_states(panel_state.read_states(spark, path)))
    assert sorted(profile.collect()) == sorted(
        panel.city_profile(two_months.filter("city is not null and date is not null"), exact_scale=panel_state.SCALE).collect()
    )


def test_landing_touches_its_own_batch_and_months_alone(spark, two_months):
    path = fresh_path(spark, "states")
    panel_state.land_incidents(two_months, path, "first")
    before = files(path)
    one_day = two_months.filter(F.col("date") == F.lit(date(2020, 2, 3)))
    panel_state.land_incidents(one_day, path, "late")
    after = files(path)
    assert before.items() <= after.items()
    assert all("month=2020-02-01/batch=late" in name for name in after.keys() - before.keys())
    panel_state.land_incidents(one_day, path, "late")  # again: replaced, not added
    assert before.items() <= files(path).items()
    counts = panel_state.merge_states(panel_state.read_states(spark, path)).agg(F.sum("accident_count")).first()[0]
    usable = two_months.filter("city is not null and date is not null").count()
    assert counts == usable + one_day.filter("city is not null").count()


def test_landing_reads_no_stored_state_and_ranges_skip_months(spark, two_months):
    path = fresh_path(spark, "states")
    panel_state.land_incidents(two_months, path, "first")
    some = panel_state.read_states(spark, path, date(2020, 2, 5), date(2020, 2, 9))
    assert all("month=2020-02-01" in name for name in some.inputFiles()) or "month" in some._jdf.queryExecution().toString()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.date for r in some.collect()} <= {date(2020, 2, d) for d in range(5, 10)}
    assert "states-" not in panel_state.day_states(two_months)._jdf.queryExecution().toString()


def test_states_of_nothing(spark):
    path = fresh_path(spark, "states")
    panel_state.land_incidents(incidents(spark, [("a", date(2020, 1, 1), None)]), path, "x")
    panel_state.land_incidents(incidents(spark, []), path, "x")  # no month: what was there stays
    row = panel_state.panel_from_states(panel_state.read_states(spark, path)).first()
    assert (row.accident_count, row.temp, row.sever) == (1, None, 0.0)


# cells ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def durations_table(spark):
    spread = lambda salt, width: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(width))
    return stage(
        spark.range(4000).select(
            "id",
            spread(1, 24).cast("int").alias("hour"),
            (spread(2, 4) + 1).cast("string").alias("severity"),
            F.concat(F.lit("S"), spread(3, 7).cast("string")).alias("state"),
            (spread(4, 900) / 10).alias("distance"),
            (spread(5, 300) + spread(1, 24) * 4 + spread(4, 900) / 9 + 1.0).alias("duration_minutes"),
        ),
        "durations",
    )


@pytest.mark.parametrize("bins", [16, 128])
def test_trees_on_cells_equal_trees_on_rows(durations_table, bins):
    train, valid = durations_table.filter("id % 5 > 0"), durations_table.filter("id % 5 = 0")
    folded = cells.search_folded_tree(train, valid, (2, 4), (1, 3), bins=bins)
    *prepare, _ = folded.model.stages
    assert [list(stage.labels) for stage in prepare[:2]] == [list(x) for x in duration.fit_index(train).labelsArray]
    plain = search_tree(prepare, train, valid, duration.LABEL, (2, 4), (1, 3), max_bins=128)
    for a, b in zip(folded.rows, plain.rows):
        assert {k: v for k, v in a.items() if k != "is_best"} == pytest.approx({k: v for k, v in b.items() if k != "is_best"})
    one = [r.prediction for r in folded.model.transform(valid).orderBy("id").collect()]
    two = [r.prediction for r in plain.model.transform(valid).orderBy("id").collect()]
    assert one == pytest.approx(two)


def test_least_rows_of_a_leaf_hold_as_weights(durations_table):
    train = durations_table.filter("id < 600")
    search = cells.search_folded_tree(train, train, (6,), (40,))
    sizes = search.model.transform(train).groupBy("prediction").count().collect()
    assert len(sizes) > 3 and min(r["count"] for r in sizes) >= 40


def test_cells_do_not_grow_with_the_rows(durations_table):
    cutter = cells.distance_bins(durations_table, 8)
    once = cells.fold(durations_table, cutter).count()
    many = durations_table.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5))))
    assert cells.fold(many, cutter).count() == once <= 24 * 4 * 7 * 8
    assert cells.fold(many, cutter).agg(F.sum("rows")).first()[0] == 20_000


def test_few_distances_get_a_bin_each(spark):
    rows = spark.createDataFrame([(d, i) for i, d in enumerate([1.0, 1.0, 2.0, 5.0, 5.0, 5.0])], "distance double, id int")
    found = cells.distance_bins(rows).transform(rows).select("distance", cells.BIN).distinct().collect()
    assert len({r[cells.BIN] for r in found}) == 3
    with pytest.raises(ValueError, match="empty"):
        cells.distance_bins(rows.limit(0))


# groups ---------------------------------------------------------------------------


FEATURES = ["avg_temp", "avg_humidity"]


def cities(spark, points):
    rows = [(f"c{n:03}", float(x), float(y)) for n, (x, y) in enumerate(points)]
    return stage(spark.createDataFrame(rows, "city string, avg_temp double, avg_humidity double"), "cities")


def cost_of(points, groups):
    total = 0.0
    for g in set(groups):
        members = [p for p, h in zip(points, groups) if h == g]
        centre = [sum(c) / len(members) for c in zip(*members)]
        total += sum(math.dist(p, centre) ** 2 for p in members)
    return total


def groups_of(found):
    return [r.cluster for r in found.table.orderBy("city").collect()]


@pytest.fixture(scope="module")
def scattered():
    rng = random.Random(6)
    return [(rng.gauss(20 * (n % 5), 6), rng.gauss(15 * (n % 3), 6)) for n in range(120)]


@pytest.mark.parametrize("scale", [False, True])
def test_groups_do_not_follow_the_layout(spark, scattered, scale):
    table = cities(spark, scattered)
    answers = [
        grouping.group_cities(frame, features=FEATURES, scale=scale, starts=1)
        for frame in ((table, table.repartition(7)) if scale else (table, table.repartition(1), table.repartition(50, "avg_temp")))
    ]
    assert len({tuple(groups_of(a)) for a in answers}) == 1
    assert len({a.cost for a in answers}) == 1 and all(a.centres == answers[0].centres for a in answers)


def test_groups_are_a_local_optimum(spark, scattered):
    found = grouping.group_cities(cities(spark, scattered), features=FEATURES)
    groups = groups_of(found)
    cost = cost_of(scattered, groups)
    assert set(groups) == set(range(5)) and found.cost == pytest.approx(cost)
    temps = [centre[0] for centre in found.centres]
    assert temps == sorted(temps)
    for g, centre in enumerate(found.centres):
        members = [p for p, h in zip(scattered, groups) if h == g]
        assert centre == pytest.approx([sum(c) / len(members) for c in zip(*members)])
    for n in range(len(scattered)):
        for g in range(5):
            moved = [*groups[:n], g, *groups[n + 1 :]]
            assert cost_of(scattered, moved) >= cost * (1 - 1e-9)


@pytest.mark.parametrize("seed", range(2))
def test_groups_on_a_line_are_the_best_there_are(spark, seed):
    rng = random.Random(seed)
    values = sorted(rng.choice([rng.gauss(0, 1), rng.gauss(5, 2), rng.uniform(-9, 9)]) for _ in range(30))
    found = grouping.group_cities(cities(spark, [(v, 0.0) for v in values]), k=3, features=["avg_temp"])
    points = [(v,) for v in values]
    best = min(cost_of(points, [(n >= a) + (n >= b) for n in range(30)]) for a, b in combinations(range(1, 30), 2))
    assert cost_of(points, groups_of(found)) == pytest.approx(best, rel=1e-6)


def test_odd_city_tables(spark):
    few = cities(spark, [(1, 1), (1, 1), (2, 2)])
    assert groups_of(grouping.group_cities(few, features=FEATURES)) == [0, 0, 1]
    same = cities(spark, [(1, 1)] * 4)
    assert groups_of(grouping.group_cities(same, features=FEATURES)) == [0, 0, 0, 0]
    assert grouping.group_cities(same.limit(0), features=FEATURES).table.count() == 0
    with pytest.raises(ValueError, match="avg_temp"):
        grouping.group_cities(few.withColumn("avg_temp", F.lit(None).cast("double")), features=FEATURES)
    with pytest.raises(ValueError, match="avg_temp"):
        grouping.group_cities(few.withColumn("avg_temp", F.lit(float("nan"))), features=FEATURES)
