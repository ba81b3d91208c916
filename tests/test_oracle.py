from __future__ import annotations

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    difference = compare(spark, con, queries()[name], oracle_sql()[name], SF)
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_gives_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["gbt_exact", "duration_tree_exact", "hour_tree_exact"])
def test_sql_refuses_a_constant_model(spark, con, name):
    def constant(session, sf_dir):
        found = queries()[name](session, sf_dir)
        return found.withColumn("prediction", F.lit(found.agg(F.avg("prediction")).first()[0]))

    assert compare(spark, con, constant, oracle_sql()[name], SF) is not None
