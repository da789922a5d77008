"""Flows that must hold whatever the cluster: roots, events, plans."""

import time

import pytest

from presslake.operators.extract import extract_headlines, with_source
from presslake.operators.outline import Outline, read_items
from presslake.operators.rules import BLOCK_CARDS, DAILY_SOURCES
from presslake.plans.classify import numbered_titles
from presslake.sinks.tables import write_page_files
from presslake.sources.pages import qualified_root, read_event_pages, scan_pages
from tests.test_tables import write_file


def test_roots_may_be_spelled_in_any_way(spark, tmp_path, monkeypatch):
    write_file(tmp_path / "lake", "headlines/raw/s/a.html", "<p>a</p>")
    monkeypatch.chdir(tmp_path)
    for root in (f"{tmp_path}//lake", f"{tmp_path}/lake/../lake/", f"file:{tmp_path}/lake", f"file://{tmp_path}/lake"):
        assert [row.key for row in scan_pages(spark, root).collect()] == ["headlines/raw/s/a.html"]
    assert qualified_root(spark, f"{tmp_path}/a/../b//c/") == f"file:{tmp_path}/b/c"
    home = spark._jvm.java.lang.System.getProperty("user.dir")
    assert qualified_root(spark, "lake") == f"file:{home}/lake"


def test_pages_are_not_written_to_each_machines_disk(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([("s", "k.html", "x")], "source string, key string, html string")
    monkeypatch.setattr("presslake.sinks.tables.is_local", lambda session: False)
    with pytest.raises(ValueError, match="each machine"):
        write_page_files(pages, str(tmp_path))


def test_a_cluster_writes_pages_to_its_shared_folder(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([("s", "k.html", "x")], "source string, key string, html string")
    monkeypatch.setattr("presslake.sinks.tables.is_local", lambda session: False)
    monkeypatch.setattr("presslake.session.shared_dir", lambda session: f"file://{tmp_path}/shared")
    rows = write_page_files(pages, f"{tmp_path}/shared/lake").collect()
    assert [(row.key, row.n_bytes, row.error) for row in rows] == [("k.html", 1, None)]
    assert (tmp_path / "shared/lake/k.html").read_text() == "x"
    with pytest.raises(ValueError, match="each machine"):
        write_page_files(pages, f"{tmp_path}/other")


def test_event_pages_are_read_by_name(spark, tmp_path):
    write_file(tmp_path / "b1", "headlines/raw/a é.html", "<p>a</p>")
    write_file(tmp_path / "b2", "headlines/raw/a é.html", b"\xff")
    write_file(tmp_path / "b2", "headlines/raw/not_named.html", "x")

    def body(bucket, key):
        return '{"Records": [{"s3": {"bucket": {"name": "%s"}, "object": {"key": "%s"}}}]}' % (bucket, key)

    key = "headlines/raw/a+%C3%A9.html"
    bodies = [body("b1", key), body("b1", key), body("b2", key), body("b1", "headlines/raw/gone.html"), "bad"]
    events = spark.createDataFrame([(b,) for b in bodies], "body string")
    rows = read_event_pages(events, f"file://{tmp_path}/{{bucket}}").collect()
    found = {(r.bucket, r.key): (r.html, r.error) for r in rows}
    assert len(rows) == 4
    assert found[("b1", "headlines/raw/a é.html")] == ("<p>a</p>", None)
    assert found[("b2", "headlines/raw/a é.html")] == (None, "not valid UTF-8")
    assert found[("b1", "headlines/raw/gone.html")][1].startswith("FileNotFoundError")
    assert found[(None, None)] == (None, "not an object notification")


def test_filters_on_kept_columns_go_below_the_one_parse(spark):
    pages = spark.createDataFrame([("headlines/raw/eltiempo/d/a.html", "<p>")], "key string, html string")
    rows = extract_headlines(with_source(pages), DAILY_SOURCES).filter("source = 'eltiempo' AND title <> 'x'")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    parses = [i for i, line in enumerate(lines) if "EvalPython" in line]
    assert len(parses) == 1
    assert "eltiempo" in "".join(lines[parses[0] + 1 :])


def test_unclosed_items_take_linear_time():
    def seconds(n):
        markup = "<div class=BlockContainer-Content><h2 class=Card-Title>t</h2>" * n
        started = time.perf_counter()
        assert len(read_items(markup, BLOCK_CARDS)) == n
        return time.perf_counter() - started

    seconds(100)
    assert seconds(20_000) < 12 * max(seconds(4_000), 0.05)


def test_missing_fields_take_linear_time():
    markup = "<div class=BlockContainer-Content>" * 20_000
    started = time.perf_counter()
    assert len(read_items(markup, BLOCK_CARDS)) == 20_000
    assert time.perf_counter() - started < 20
    assert Outline("<p>a</p>").runs == ["a"]


def test_numbered_titles_do_not_depend_on_files(spark):
    rows = [("gol", 1)] * 25 + [("cine", 4)] * 3 + [("otro", 0)]
    frame = spark.createDataFrame(rows, "title string, label int")
    one, many = (
        sorted(map(tuple, numbered_titles(frame.repartition(n), per_task=4).collect())) for n in (1, 7)
    )
    assert one == many and len({row[2] for row in one}) == len(rows)
    assert sorted((title, label) for title, label, _ in one) == sorted(rows)
