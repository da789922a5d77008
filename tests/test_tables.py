import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from presslake.functions.keys import FINAL_PREFIX
from presslake.operators.catalog import list_partitions, refresh_partitions, register_final
from presslake.operators.rules import BLOCK_CARDS, STORY_CARDS
from presslake.plans.headlines import publish_final, publish_processed
from presslake.plans.landing import land_fetches
from presslake.sinks import tables as sinks
from presslake.sources.pages import scan_pages
from presslake.sources.tables import (
    scan_final,
    scan_headline_csv,
    scan_landed,
    scan_scraped_json,
)

TRICKY = ['say "hi"', "a;b", "a,b", "line\nbreak", "carriage\r\nreturn", " spaces ", "fútbol", "", '"', "\\", "'"]
AS_OF = "2025-06-01 07:08:09"


def write_file(root, key, body):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(body if isinstance(body, bytes) else body.encode())


def headline_frame(spark, texts, day="05"):
    rows = [(str(i), t, "/l", "2025-05-05 00:00:00", "s", "2025", "05", day) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "categoria string, titular string, enlace string, fecha_extraccion string, "
        "periodico string, year string, month string, day string"
    )


def test_final_table_round_trip_and_pruning(spark, tmp_path):
    location = str(tmp_path / "final")
    sinks.write_final(headline_frame(spark, TRICKY), location)
    sinks.write_final(headline_frame(spark, ["otro día"], day="06"), location)
    register_final(spark, "final_round_trip", location)
    rows = scan_final(spark, "final_round_trip", day="05").collect()
    assert sorted((row.categoria, row.titular) for row in rows) == sorted(
        (str(i), t) for i, t in enumerate(TRICKY)
    )
    assert {(row.periodico, row.month, row.day) for row in rows} == {("s", "05", "05")}
    plan = scan_final(spark, "final_round_trip", day="05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    names = [row.partition for row in list_partitions(spark, "final_round_trip").collect()]
    assert names == [f"periodico=s/year=2025/month=05/day={d}" for d in ("05", "06")]
    with pytest.raises(ValueError, match="periodo"):
        scan_final(spark, "final_round_trip", periodo="s")


def test_rewriting_a_day_replaces_only_that_day(spark, tmp_path):
    location = str(tmp_path / "final")
    sinks.write_final(headline_frame(spark, ["a", "b"]), location)
    sinks.write_final(headline_frame(spark, ["c"], day="06"), location)
    sinks.write_final(headline_frame(spark, ["d"]), location)
    register_final(spark, "final_rewritten", location)
    rows = scan_final(spark, "final_rewritten").collect()
    assert sorted((row.day, row.titular) for row in rows) == [("05", "d"), ("06", "c")]


def test_new_partitions_show_after_a_refresh(spark, tmp_path):
    location = str(tmp_path / "final")
    sinks.write_final(headline_frame(spark, ["a"]), location)
    register_final(spark, "final_refreshed", location)
    sinks.write_final(headline_frame(spark, ["b"], day="06"), location)
    assert scan_final(spark, "final_refreshed").count() == 1
    refresh_partitions(spark, "final_refreshed")
    assert scan_final(spark, "final_refreshed").count() == 2


def test_the_final_file_is_plain_semicolon_csv(spark, tmp_path):
    location = tmp_path / "final"
    sinks.write_final(headline_frame(spark, ['di "hola"']), str(location))
    folder = location / "periodico=s" / "year=2025" / "month=05" / "day=05"
    (name,) = [name for name in os.listdir(folder) if name.endswith(".csv")]
    assert (folder / name).read_text() == (
        'categoria;titular;enlace;fecha_extraccion\n0;"di ""hola""";/l;2025-05-05 00:00:00\n'
    )


def test_a_hot_partition_is_split_over_tasks(spark, tmp_path):
    location = str(tmp_path / "final")
    rows = spark.range(40_000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("categoria"), F.lit("t").alias("titular"),
        F.lit("l").alias("enlace"), F.lit("f").alias("fecha_extraccion"), F.lit("s").alias("periodico"),
        F.lit("2025").alias("year"), F.lit("05").alias("month"), F.lit("05").alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        sinks.write_final(rows.repartition(4), location)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for _, _, names in os.walk(location) for f in names if f.endswith(".csv")]
    assert len(files) > 1
    register_final(spark, "final_hot", location)
    assert scan_final(spark, "final_hot").count() == 40_000


def test_processed_round_trip(spark, tmp_path):
    path = str(tmp_path / "processed")
    rows = [("c", text, str(i)) for i, text in enumerate(TRICKY)]
    sinks.write_processed(spark.createDataFrame(rows, "category string, title string, description string"), path)
    for schema in ({}, {"schema": None}):
        found = scan_headline_csv(spark, path, **schema)
        assert found.columns == ["category", "title", "description"]
        assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_nested_files_are_not_part_of_a_csv_scan(spark, tmp_path):
    write_file(tmp_path, "p/a.csv", "category,title,description\nc,uno,d\n")
    write_file(tmp_path, "p/q/b.csv", "category,title,description\nc,dos,d\n")
    assert [row.title for row in scan_headline_csv(spark, str(tmp_path / "p")).collect()] == ["uno"]


def test_scraped_json(spark, tmp_path):
    path = str(tmp_path / "scraped")
    rows = [("c", text, "No link") for text in TRICKY]
    sinks.write_scraped(spark.createDataFrame(rows, "category string, title string, link string"), path)
    assert sorted(map(tuple, scan_scraped_json(spark, path).collect())) == sorted(rows)
    write_file(tmp_path, "array.json", '[\n {"category": "c", "title": "ñandú", "link": "l"},\n {"title": "t"}\n]')
    found = scan_scraped_json(spark, str(tmp_path / "array.json"), multi_line=True)
    assert sorted(map(tuple, found.collect()), key=str) == [("c", "ñandú", "l"), (None, "t", None)]


def test_nothing_is_written_for_no_scraped_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "category string, title string, link string")
    sinks.write_scraped(empty, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_page_scan(spark, tmp_path):
    write_file(tmp_path, "headlines/raw/s/2025-05-26/a.html", "<p>ñ</p>")
    write_file(tmp_path, "headlines/raw/b.html", b"\xff\xfe")
    write_file(tmp_path, "headlines/raw/notes.txt", "x")
    write_file(tmp_path, "other/c.html", "x")
    rows = sorted(map(tuple, scan_pages(spark, str(tmp_path)).collect()))
    assert rows == [
        ("headlines/raw/b.html", None, "not valid UTF-8"),
        ("headlines/raw/s/2025-05-26/a.html", "<p>ñ</p>", None),
    ]
    with pytest.raises(Exception, match="UTF8|UTF-8"):
        scan_pages(spark, str(tmp_path), mode="FAILFAST").collect()


def test_no_pages(spark, tmp_path):
    assert scan_pages(spark, str(tmp_path)).count() == 0


def test_landing_a_day_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "landed")
    schema = "key string, html string, source string, date string"
    sinks.land_pages(spark.createDataFrame([("k1", "old", "s", "2025-05-26"), ("k2", "x", "t", "2025-05-26")], schema), path)
    sinks.land_pages(spark.createDataFrame([("k1", "new", "s", "2025-05-26")], schema), path)
    rows = sorted(map(tuple, scan_landed(spark, path).collect()))
    assert rows == [("k1", "new", "s", "2025-05-26"), ("k2", "x", "t", "2025-05-26")]


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_page_files(spark, tmp_path, scheme):
    pages = spark.createDataFrame(
        [("s", "headlines/raw/s/a b.html", "ñ\n"), ("c", "headlines/raw/c.html", "x")],
        "source string, key string, html string",
    )
    written = sinks.write_page_files(pages, scheme + str(tmp_path)).collect()
    assert sorted(map(tuple, written)) == [
        ("c", "headlines/raw/c.html", 1, None), ("s", "headlines/raw/s/a b.html", 3, None),
    ]
    assert sorted(tuple(row)[:2] for row in scan_pages(spark, str(tmp_path)).collect()) == [
        ("headlines/raw/c.html", "x"), ("headlines/raw/s/a b.html", "ñ\n"),
    ]


def test_landing_isolates_failures(spark, tmp_path):
    """A failed fetch and a failed write leave a message; the third source lands."""
    write_file(tmp_path, "headlines/raw/blocked", "a file where a folder should go")
    fetches = spark.createDataFrame(
        [("eltiempo", "http_error", "500 Server Error", None), ("blocked", "ok", None, "<p>b</p>"),
         ("elespectador", "ok", None, "<h2>News</h2>")],
        "source string, outcome string, error string, html string",
    )
    messages = {row.source: row.message for row in land_fetches(fetches, str(tmp_path), AS_OF).collect()}
    key = "headlines/raw/elespectador/2025-06-01/elespectador_2025-06-01.html"
    assert messages["eltiempo"] == "Error al descargar de eltiempo: 500 Server Error"
    assert messages["elespectador"] == f"Successfully uploaded elespectador to {key}"
    assert messages["blocked"].startswith("Error inesperado al procesar blocked: ")
    assert [tuple(row)[:2] for row in scan_pages(spark, str(tmp_path)).collect()] == [(key, "<h2>News</h2>")]
    again = spark.createDataFrame([("elespectador", "ok", None, "later")], fetches.schema)
    land_fetches(again, str(tmp_path), AS_OF).collect()
    assert [row.html for row in scan_pages(spark, str(tmp_path)).collect()] == ["later"]


CARD = '<article class="story-card"><h2 class="title">{0}</h2><a class="title" href="/{0}">x</a></article>'


def final_titles(spark, location):
    rows = spark.read.options(header=True, sep=";", escape='"', multiLine=True).csv(location)
    return sorted(row.titular for row in rows.collect())


def write_lake(root):
    write_file(root, "headlines/raw/eltiempo/2025-05-26/a.html", CARD.format("a"))
    write_file(root, "headlines/raw/eltiempo/2025-05-26/b.html", CARD.format("b"))
    write_file(root, "headlines/raw/eltiempo/2025-05-26/c.html", "<p>nada</p>")
    write_file(root, "headlines/raw/eltiempo/2025-05-26-1/d.html", CARD.format("d"))
    write_file(root, "headlines/raw/eltiempo/e.html", CARD.format("e"))
    write_file(root, "headlines/raw/otro/2025-05-26/f.html", CARD.format("f"))
    write_file(root, "headlines/raw/eltiempo/2025-05-26/g.html", b"\xff" + CARD.format("g").encode())


def test_publish_final(spark, tmp_path):
    write_lake(tmp_path)
    published = publish_final(spark, str(tmp_path), as_of=AS_OF, table="published")
    assert final_titles(spark, published.location) == ["a", "b", "e"]
    rows = scan_final(spark, "published").collect()
    days = {row.titular: (row.periodico, row.year, row.month, row.day) for row in rows}
    assert days["a"] == ("eltiempo", "2025", "05", "26")
    assert days["e"] == ("eltiempo", "2025", "06", "01")
    assert {row.fecha_extraccion for row in rows} == {AS_OF}
    assert [row.key for row in published.unknown_sources.collect()] == ["headlines/raw/otro/2025-05-26/f.html"]
    fared = {row.key.split("/")[-1]: (row.n_headlines, row.error) for row in published.files.collect()}
    assert fared == {
        "a.html": (1, None), "b.html": (1, None), "c.html": (0, None), "e.html": (1, None),
        "d.html": (1, "date folder has more than three parts"), "g.html": (0, "not valid UTF-8"),
    }


def test_publish_nothing(spark, tmp_path):
    published = publish_final(spark, str(tmp_path), as_of=AS_OF)
    assert published.files.isEmpty()


@pytest.mark.parametrize("source, empty", [("otro", 0), ("eltiempo", 2)])
def test_publish_pages_without_headlines(spark, tmp_path, source, empty):
    for name in "ab":
        write_file(tmp_path, f"headlines/raw/{source}/2025-05-26/{name}.html", "<p>nada</p>")
    for collision in ("keep_all", "last"):
        published = publish_final(spark, str(tmp_path), as_of=AS_OF, on_collision=collision)
        assert [row.n_headlines for row in published.files.collect()] == [0] * empty


def test_publish_from_landed_tables(spark, tmp_path):
    landed = str(tmp_path / "landed")
    key = "headlines/raw/eltiempo/2025-05-26/a.html"
    schema = "key string, html string, source string, date string"
    sinks.land_pages(spark.createDataFrame([(key, CARD.format("a"), "eltiempo", "2025-05-26")], schema), landed)
    pages = scan_landed(spark, landed).select("key", "html")
    published = publish_final(spark, str(tmp_path), as_of=AS_OF, pages=pages)
    assert final_titles(spark, published.location) == ["a"]


def test_publish_final_keeps_the_last_writer(spark, tmp_path):
    write_lake(tmp_path)
    published = publish_final(spark, str(tmp_path), as_of=AS_OF, on_collision="last")
    assert final_titles(spark, published.location) == ["b", "e"]
    again = publish_final(spark, str(tmp_path), as_of=AS_OF, on_collision="last")
    assert final_titles(spark, again.location) == ["b", "e"]
    with pytest.raises(ValueError, match="first"):
        publish_final(spark, str(tmp_path), on_collision="first")


def test_publish_processed(spark, tmp_path):
    card = '<div class="BlockContainer-Content"><h2 class="Card-Title">{}</h2></div>'
    write_file(tmp_path, "headlines/raw/x_1.html", card.format("uno") + card.format("dos"))
    write_file(tmp_path, "headlines/raw/x_2.html", "<p>")
    path = publish_processed(spark, str(tmp_path))
    rows = sorted(map(tuple, scan_headline_csv(spark, path).collect()))
    assert rows == [("No category", t, "No description") for t in ("dos", "uno")]


def test_default_clock_is_the_query_start(spark, tmp_path):
    write_file(tmp_path, "headlines/raw/eltiempo/e.html", CARD.format("e"))
    before = dt.datetime.now(dt.timezone.utc).date()
    published = publish_final(spark, str(tmp_path), {"eltiempo": STORY_CARDS})
    row = spark.read.options(header=True, sep=";").csv(published.location).first()
    day = dt.datetime.strptime(row.fecha_extraccion, "%Y-%m-%d %H:%M:%S").date()
    assert before <= day <= dt.datetime.now(dt.timezone.utc).date()
    assert os.path.isdir(f"{tmp_path}/{FINAL_PREFIX}periodico=eltiempo")
    assert BLOCK_CARDS.link is None
