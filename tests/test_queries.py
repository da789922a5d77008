"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from presslake.queries.registry import ORACLES, QUERIES
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, QUERIES[name], ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert set(QUERIES) - set(ORACLES) == {"train_predict", "classification_text"}


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns[:4] == ["categoria", "titular", "enlace", "fecha_extraccion"]
    assert not frame.isEmpty()


def test_languages_are_told_apart(spark, duck):
    rows = queries()["train_predict"](spark, SF_DIR).collect()
    held_out = duck.sql(oracle_sql()["split_rows"]).filter("split = 'test'").fetchall()
    assert len(rows) == len(held_out)
    assert sum(row.label == row.prediction for row in rows) >= 0.9 * len(rows)
