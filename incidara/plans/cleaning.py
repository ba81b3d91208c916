"""Cleaning: audit, impute, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from incidara.operators.quality import (
    deduplicate,
    drop_nulls,
    duplicate_audit,
    fill_means,
    profile_and_means,
)
from incidara.schema import WEATHER_MEASURES, with_incident_names, with_library_names
from incidara.session import stage
from incidara.sinks import write_csv, write_table


def clean(
    incidents: DataFrame,
    out: str,
    measures: Sequence[str] = WEATHER_MEASURES,
    keep_duplicates: bool = True,
    as_csv: bool = False,
    published_names: bool | None = None,
) -> dict[str, DataFrame]:
    """Write the cleaned table to ``out``/cleaned and return the audits.

    All columns are written. Duplicates are counted, by row hashes of the
    written table, and by default kept. The raw table is read twice: once for
    non-null counts and means together, once to write. ``published_names``
    writes known columns under the published file's names; by default so for
    CSV. The returned ``cleaned`` table has the names used here either way.
    """
    spark = incidents.sparkSession
    profile, means = profile_and_means(incidents, measures)
    filled = drop_nulls(fill_means(incidents, means), measures)
    if not keep_duplicates:
        filled = deduplicate(filled)
    if as_csv if published_names is None else published_names:
        filled = with_incident_names(filled)
    path = f"{out}/cleaned"
    if as_csv:
        write_csv(filled, path)
        written = spark.read.schema(filled.schema).csv(path, header=True)
    else:
        write_table(filled, path)
        written = spark.read.schema(filled.schema).parquet(path)
    return {
        "non_null": profile,
        "duplicates": stage(duplicate_audit(written, by_hash=True), "duplicates"),
        "cleaned": with_library_names(written),
    }
