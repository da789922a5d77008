import hashlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from presslake.functions import keys as K
from presslake.functions.outcomes import FETCHED, HTTP_ERROR, OTHER_ERROR
from presslake.operators.collisions import last_writers
from presslake.operators.landing import fetch_outcomes, landed_pages, outcome_summary
from presslake.sources.pages import event_objects, key_below, page_events

AS_OF = "2025-06-01 07:08:09"
DATED = "headlines/raw/s/2025-05-26/s_2025-05-26.html"


def value(spark, function, key, *args):
    frame = spark.createDataFrame([(key,)], "key string")
    return frame.select(function(F.col("key"), *args).alias("v")).first().v


@pytest.mark.parametrize(
    "key, source, folder, dated",
    [
        (DATED, "s", "2025-05-26", True),
        ("headlines/raw/flat_1.html", "flat_1.html", "raw", False),
        ("headlines/raw/s/2025-05-26x/a.html", "s", "2025-05-26x", True),
        ("headlines/raw/s/x2025-05-26/a.html", "s", "x2025-05-26", False),
        ("a.html", "unknown", None, False),
        ("a/b.html", "unknown", "a", False),
        ("headlines/raw//2025-05-26/a.html", "", "2025-05-26", True),
        ("headlines/raw/s/٢٠٢٥-٠٥-٢٦/a.html", "s", "٢٠٢٥-٠٥-٢٦", True),
    ],
)
def test_parse(spark, key, source, folder, dated):
    assert value(spark, K.source_of, key) == source
    assert value(spark, K.date_segment, key) == folder
    assert value(spark, lambda k: K.is_dated(K.date_segment(k)), key) is dated


@pytest.mark.parametrize(
    "key, fields, error",
    [
        (DATED, ("s", "2025", "05", "26"), None),
        ("headlines/raw/s/2025-05-26x/a.html", ("s", "2025", "05", "26x"), None),
        ("headlines/raw/flat_1.html", ("flat_1.html", "2025", "06", "01"), None),
        ("headlines/raw/s/2025-05-26-1/a.html", None, "date folder has more than three parts"),
        ("a.html", None, "key has no folder"),
    ],
)
def test_partition(spark, key, fields, error):
    assert value(spark, K.key_error, key) == error
    if fields:
        found = {
            name: value(spark, lambda k: K.partition_fields(k, AS_OF)[name], key)
            for name in ("periodico", "year", "month", "day")
        }
        assert tuple(found.values()) == fields


def test_built_keys(spark):
    assert value(spark, K.raw_key, "s", AS_OF) == "headlines/raw/s/2025-06-01/s_2025-06-01.html"
    assert (
        value(spark, K.flat_raw_key, "s", dt.datetime(2025, 6, 1, 7, 8, 9))
        == "headlines/raw/s_archive_page_1_20250601070809.html"
    )
    assert (
        value(spark, K.final_key, DATED, AS_OF)
        == "headlines/final/periodico=s/year=2025/month=05/day=26/s_2025-05-26.csv"
    )
    assert (
        value(spark, K.final_key, "headlines/raw/f.html", AS_OF)
        == "headlines/final/periodico=f.html/year=2025/month=06/day=01/f.html_2025-06-01.csv"
    )
    assert (
        value(spark, K.processed_key, "headlines/raw/a.html/headlines/raw/b.html")
        == "headlines/processed/a.csv/headlines/processed/b.csv"
    )


def test_page_keys(spark):
    wanted = {DATED: True, "headlines/raw/a.txt": False, "x/headlines/raw/a.html": False}
    for key, good in wanted.items():
        assert value(spark, K.is_page_key, key) is good


@pytest.mark.parametrize(
    "key, decoded",
    [("a+b%20c", "a b c"), ("caf%C3%A9", "café"), ("100%", "100%"), ("%zz%2B", "%zz+"), ("%%41", "%A")],
)
def test_decode(spark, key, decoded):
    assert value(spark, K.decode_key, key) == decoded


@pytest.mark.parametrize(
    "path, root",
    [
        ("file:/lake/headlines/raw/a.html", "/lake"),
        ("file:///lake/headlines/raw/a.html", "file:/lake/"),
        ("s3a://bucket/lake/headlines/raw/a.html", "s3a://bucket/lake"),
        ("hdfs://host:8020/headlines/raw/a.html", "hdfs://host:8020"),
    ],
)
def test_key_below_root(spark, path, root):
    assert value(spark, key_below, path, root) == "headlines/raw/a.html"


def test_collisions_keep_the_greatest_key(spark):
    files = spark.createDataFrame(
        [("headlines/raw/s/2025-05-26/a.html", 1), ("headlines/raw/s/2025-05-26/b.html", 2),
         ("headlines/raw/s/2025-05-27/a.html", 3), ("headlines/raw/t/2025-05-26/a.html", 4)],
        "key string, n int",
    )
    assert sorted(row.n for row in last_writers(files).collect()) == [2, 3, 4]


FETCHES = "source string, outcome string, error string, html string"


def test_one_failed_source_does_not_stop_the_other(spark):
    fetches = spark.createDataFrame(
        [("eltiempo", HTTP_ERROR, "500 Server Error", None),
         ("elespectador", FETCHED, None, "<h2>News</h2>"),
         ("otro", OTHER_ERROR, None, None)],
        FETCHES,
    )
    outcomes = fetch_outcomes(fetches, as_of=AS_OF)
    messages = {row.source: row.message for row in outcomes.collect()}
    key = "headlines/raw/elespectador/2025-06-01/elespectador_2025-06-01.html"
    assert messages == {
        "eltiempo": "Error al descargar de eltiempo: 500 Server Error",
        "elespectador": f"Successfully uploaded elespectador to {key}",
        "otro": "Error inesperado al procesar otro: ",
    }
    position = F.when(F.col("source") == "eltiempo", 0).when(F.col("source") == "otro", 2).otherwise(1)
    summary = outcome_summary(outcomes, position).first().summary
    assert summary == "; ".join([messages["eltiempo"], messages["elespectador"], messages["otro"]])
    landed = landed_pages(fetches, AS_OF).collect()
    assert [(row.key, row.html, row.date) for row in landed] == [(key, "<h2>News</h2>", "2025-06-01")]


def test_events(spark):
    body = (
        '{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "headlines/raw/a+b%C3%A9.html"}}},'
        ' {"s3": {"bucket": {"name": "b"}, "object": {"key": "other/c.html"}}}]}'
    )
    bodies = [body, '{"Records": []}', "no json", "{}", '{"Records": [{"s3": {"bucket": {"name": "b"}}}]}', None]
    events = spark.createDataFrame([(b,) for b in bodies], "body string")
    page, bad = ("b", "headlines/raw/a bé.html", None), (None, None, "not an object notification")
    nameless = ("b", None, "names no object")
    objects = [tuple(row) for row in event_objects(events).collect()]
    assert objects == [page, ("b", "other/c.html", None), bad, bad, nameless, bad]
    assert [tuple(row) for row in page_events(events).collect()] == [page, bad, bad, nameless, bad]


def test_a_source_lands_one_page_a_day(spark):
    rows = [("s", FETCHED, None, "a"), ("s", FETCHED, None, "b"), ("s", FETCHED, None, "b"), ("t", FETCHED, None, "c"),
            ("s", HTTP_ERROR, "500", None)]
    greatest = max("ab", key=lambda html: hashlib.md5(html.encode()).hexdigest())
    landed = landed_pages(spark.createDataFrame(rows, FETCHES), AS_OF).collect()
    assert sorted((row.source, row.html) for row in landed) == [("s", greatest), ("t", "c")]


def test_a_path_outside_the_root_is_an_error(spark):
    with pytest.raises(Exception, match="is not below"):
        value(spark, key_below, "file:/other/headlines/raw/a.html", "/lake")
