"""Incident tables mapped from the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from incidara.operators.splits import TimeBounds

# Time split for the daily table (its days run from 1995 to 2001).
DAILY_BOUNDS = TimeBounds(valid_start=date(2000, 1, 1), test_start=date(2001, 1, 1))

# Decimals kept in sums, so that two engines add up to the same last digit.
EXACT_SCALE = 4

EVENT_SEVERITY = ["click", "error", "purchase", "signup", "view"]  # severity 1-5
STATES = 50
CITIES = 25


# The test tables' types. Stated, so that no job has to open files to find them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def incidents_daily(spark: SparkSession, sf_dir: str, nulls: bool = False) -> DataFrame:
    """Line items as incidents: nation is the city, order date the day.

    No join carries a hint. The two lists of nations and regions are far
    under Spark's broadcast threshold; customers are broadcast or shuffled
    as their size tells, and the order join is a shuffle that AQE splits
    where one key is too large.
    """
    line, order, customer, nation, region = (
        table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation", "region")
    )
    place = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    )
    placed = order.join(place, order.o_custkey == place.c_custkey)
    rows = line.join(placed, line.l_orderkey == placed.o_orderkey)

    def measure(name: str, missing: float):
        column = F.col(name)
        return F.nullif(column, F.lit(missing)) if nulls else column

    return rows.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_orderdate").alias("start_time"),
        F.to_date("o_orderdate").alias("date"),
        "city",
        "state",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("severity"),
        measure("l_quantity", 13.0).alias("temperature_f"),
        F.col("l_extendedprice").alias("humidity_pct"),
        measure("l_discount", 0.0).alias("visibility_mi"),
        measure("l_tax", 0.0).alias("precipitation_in"),
        F.col("l_returnflag").alias("weather_condition"),
    )


def incidents_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as incidents, without an end."""
    event = table(spark, sf_dir, "events")
    levels = F.array(*[F.lit(name) for name in EVENT_SEVERITY])
    return event.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("start_time"),
        F.array_position(levels, F.col("event_type")).cast("string").alias("severity"),
        "event_type",
        F.concat(F.lit("S"), (F.col("user_id") % STATES).cast("string")).alias("state"),
        (F.col("user_id") % CITIES).alias("city"),
        F.col("value").alias("distance"),
        "user_id",
    )


def with_end_time(incidents: DataFrame) -> DataFrame:
    """End of an incident: the start of the same user's next one.

    A window per user would put a very busy user into one task. So the next
    row is looked up within (user, hour); only the last row of an hour takes
    the first start of the user's next busy hour, from a table of one row per
    user and hour. The lookup joins on (user, hour), the partitioning the
    first window has already made.
    """
    cell = ["user_id", "_hour"]
    rows = incidents.withColumn("_hour", F.date_trunc("hour", "start_time"))
    inside = Window.partitionBy(*cell).orderBy("start_time", "id")
    hours = rows.groupBy(*cell).agg(F.min("start_time").alias("_first"))
    later = hours.select(
        *cell, F.lead("_first").over(Window.partitionBy("user_id").orderBy("_hour")).alias("_later")
    )
    return (
        rows.withColumn("_next", F.lead("start_time").over(inside))
        .join(later, cell, "left")
        .withColumn("end_time", F.coalesce("_next", "_later"))
        .drop("_hour", "_next", "_later")
    )
