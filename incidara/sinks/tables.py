"""Table writers. Unless said otherwise a writer fails if its target exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True
) -> None:
    """CSV folder, written in parallel; a header line per file unless told not to."""
    df.write.mode(mode).option("header", header).csv(path)


def land_by_year(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Land incidents as Parquet, one folder per year of ``start_time``.

    The rebalance hint lets AQE gather small years into few files and split a
    year that holds most rows over many tasks.
    """
    (
        df.withColumn("start_year", F.year("start_time"))
        .hint("rebalance", "start_year")
        .write.mode(mode)
        .partitionBy("start_year")
        .parquet(path)
    )


def write_result_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """A result of a few rows (24 hours, one grid) as one sorted CSV file.

    The shuffle to one partition comes after the parallel work, which
    ``coalesce(1)`` would pull into a single task.
    """
    one = df.repartition(1).sortWithinPartitions(*order)
    one.write.option("header", True).csv(path)


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    """A log of a few hundred lines as one text file."""
    rows = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    rows.repartition(1).sortWithinPartitions("n").select("value").write.text(path)
