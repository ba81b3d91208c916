"""Duration of incidents, and a tree on hour, severity, state, distance."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from incidara.models.cells import search_folded_tree
from incidara.models.metrics import PARALLEL_FITS, tuning_table
from incidara.models.trees import TreeSearch
from incidara.operators.durations import (
    duration_model_table,
    mean_duration_by_hour,
    parsed_strings,
)
from incidara.operators.quality import drop_nulls
from incidara.operators.splits import split_by_key
from incidara.session import stage
from incidara.sinks import write_result_csv, write_table


USED = ["ID", "Start_Time", "End_Time", "Severity", "State", "Distance(mi)"]


def duration_prediction(
    raw: DataFrame,
    out: str,
    any_null_drop: bool = True,
    parallelism: int = PARALLEL_FITS,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
) -> TreeSearch:
    """Run on an all-string scan and write under ``out``.

    The model table is narrow; it is staged so that the strings are parsed
    once. All trees are fitted on its cells (``models.cells``). The split is by a hash of the id, so that a re-run
    task cannot move a row between training and validation.
    """
    spark = raw.sparkSession
    rows = parsed_strings(drop_nulls(raw, None if any_null_drop else USED))
    table = stage(duration_model_table(rows, carry=["id"]), "durations")
    train, valid = split_by_key(table, "id")
    search = search_folded_tree(train, valid, parallelism=parallelism, storage=storage)
    write_table(tuning_table(spark, search.rows), f"{out}/tuning")
    scored = search.model.transform(valid)
    write_result_csv(mean_duration_by_hour(scored), f"{out}/mean_duration_by_hour", ["hour"])
    return search
