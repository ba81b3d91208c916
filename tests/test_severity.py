from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from incidara.models import severity
from incidara.session import fresh_path
from incidara.sinks import save_pipeline
from incidara.sources import load_pipeline


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).select(
        "id",
        (F.col("id") % 24).cast("int").alias("hour"),
        F.concat(F.lit("S"), (F.col("id") % 5).cast("string")).alias("state"),
        (F.col("id") % 7 / 2).alias("distance"),
        F.when(F.col("id") % 5 == 3, "4").when(F.col("id") % 24 < 10, "2").otherwise("1").alias("severity"),
    )


def test_tree_learns_state_and_hour(spark, rows):
    model = severity.fit_severity(rows)
    scored = model.transform(rows)
    assert scored.filter("severity <> predicted").isEmpty()
    path = fresh_path(spark, "severity")
    save_pipeline(model, path)
    again = load_pipeline(path).transform(rows)
    assert again.select("id", "predicted").exceptAll(scored.select("id", "predicted")).isEmpty()


def test_unseen_and_null_values_are_scored(rows):
    model = severity.fit_severity(rows)
    odd = rows.limit(3).withColumns({"state": F.when(F.col("id") > 0, "new"), "severity": F.lit("9")})
    assert all(r.predicted in {"1", "2", "4"} for r in model.transform(odd).collect())


def test_measures_follow_from_the_pairs(spark):
    pairs = [("a", "a")] * 6 + [("a", "b")] * 2 + [("b", "b")] + [("c", "a")] + [("b", None)] + [(None, "d")]
    table = severity.confusion(spark.createDataFrame(pairs, "severity string, predicted string"))
    found = {r["class"]: tuple(r)[1:] for r in severity.class_measures(table).collect()}
    assert found["a"] == pytest.approx((8, 6 / 7, 6 / 8, 12 / 15))
    assert found["b"] == pytest.approx((2, 1 / 3, 1 / 2, 2 / 5))
    assert found["c"] == (1, None, 0.0, None) and found["d"] == (0, 0.0, None, None)
    assert severity.class_measures(table.limit(0)).count() == 0
