"""Map cells: keys of bit-interleaved coordinates, whose prefixes are the coarser cells.

Level 0 is the whole map, each level parts a cell in four. A cell of level l is
a number of 2 l bits; dropping two bits gives the cell around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_LEVEL = 16  # cells of some 600 x 300 metres at the equator
TARGET = 10_000

# How far a step spreads the bits, and the mask that keeps them.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread(number: Column) -> Column:
    """Each bit of a number below 2^31 moves to twice its place."""
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def _step(value: Column, low: float, width: float, level: int) -> Column:
    place = F.floor((value - low) / width * (1 << level)).cast("bigint")
    return F.greatest(F.lit(0), F.least(F.lit((1 << level) - 1), place)).cast("bigint")


def cell_of(latitude: str, longitude: str, level: int = MAX_LEVEL) -> Column:
    """The cell of a place in degrees; null without a latitude in -90..90 and a longitude in -180..180."""
    if not 0 <= level <= 30:
        raise ValueError(f"levels are 0 to 30, not {level}")
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    key = _spread(_step(lon, -180.0, 360.0, level)).bitwiseOR(F.shiftleft(_spread(_step(lat, -90.0, 180.0, level)), 1))
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), key)


def cell_counts(incidents: DataFrame, latitude: str, longitude: str, level: int = MAX_LEVEL) -> DataFrame:
    """level, cell, n: incidents per cell and per each cell around it, up to the whole map.

    Incidents fold to cells of the finest level in one shuffle; coarser cells
    add up those, not incidents. Places off the map are left out.
    """
    finest = (
        incidents.select(cell_of(latitude, longitude, level).alias("cell"))
        .filter("cell is not null")
        .groupBy("cell")
        .agg(F.count("*").alias("n"))
    )
    up = F.explode(F.sequence(F.lit(0), F.lit(level)))
    return (
        finest.select(up.alias("level"), "cell", "n")
        .select("level", F.expr(f"shiftright(cell, 2 * ({level} - level))").alias("cell"), "n")
        .groupBy("level", "cell")
        .agg(F.sum("n").alias("n"))
    )


def split_heavy_cells(counts: DataFrame, target: int = TARGET) -> DataFrame:
    """A cover of the map by cells of at most ``target`` incidents: level, cell, n.

    A heavy cell is parted until its parts are light or of the finest level of
    ``counts`` (the outcome of :func:`cell_counts`, staged). So a cell is in the
    cover if it is light, or of the finest level, and the cell around it is heavy.
    """
    finest = counts.agg(F.max("level")).first()[0]
    around = counts.filter(F.col("n") > target).select(
        (F.col("level") + 1).alias("level"), F.col("cell").alias("around")
    )
    light = counts.filter((F.col("n") <= target) | (F.col("level") == F.lit(finest)))
    inner = light.withColumn("around", F.shiftright("cell", 2)).join(around, ["level", "around"], "left_semi")
    return light.filter("level = 0").union(inner.filter("level > 0").select("level", "cell", "n"))
