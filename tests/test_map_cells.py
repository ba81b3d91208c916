from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from incidara.operators import map_cells
from incidara.session import stage


@pytest.fixture(scope="module")
def places(spark):
    rng = random.Random(9)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(48.1, 11.5)] * 200
    rows += [(90.0, 180.0), (-90.0, -180.0), (None, 1.0), (1.0, None), (91.0, 0.0), (float("nan"), 0.0)]
    return stage(spark.createDataFrame(rows, "latitude double, longitude double"), "places")


def brute(lat, lon, level):
    x = min(int((lon + 180) / 360 * 2**level), 2**level - 1)
    y = min(int((lat + 90) / 180 * 2**level), 2**level - 1)
    return sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(level))


@pytest.mark.parametrize("level", [0, 1, 7, 30])
def test_cells_take_the_bits_in_turn(places, level):
    for r in places.withColumn("cell", map_cells.cell_of("latitude", "longitude", level)).collect():
        good = r.latitude is not None and r.longitude is not None and -90 <= r.latitude <= 90
        assert r.cell == (brute(r.latitude, r.longitude, level) if good else None)


def test_each_level_counts_every_place_once(places):
    counts = map_cells.cell_counts(places, "latitude", "longitude", 6)
    assert {r.level: r.n for r in counts.groupBy("level").agg(F.sum("n").alias("n")).collect()} == {n: 502 for n in range(7)}


@pytest.mark.parametrize("target", [1, 20, 1000])
def test_the_cover_holds_every_place_once_in_light_cells(places, target):
    counts = stage(map_cells.cell_counts(places, "latitude", "longitude", 9), "cells")
    cover = map_cells.split_heavy_cells(counts, target).collect()
    assert sum(r.n for r in cover) == 502
    assert all(r.n <= target or r.level == 9 for r in cover)
    taken = {(r.level, r.cell) for r in cover}
    assert not any((level, cell >> 2 * (r - level)) in taken for r, cell in taken for level in range(r))
    if target == 1000:
        assert taken == {(0, 0)}


def test_no_places(places):
    counts = stage(map_cells.cell_counts(places.limit(0), "latitude", "longitude", 3), "cells")
    assert counts.count() == 0 and map_cells.split_heavy_cells(counts).count() == 0
    with pytest.raises(ValueError):
        map_cells.cell_of("a", "b", 31)
