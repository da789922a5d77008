import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from presslake.operators import rules as R
from presslake.operators.extract import (
    extract_headlines,
    final_columns,
    headline_count,
    parse_pages,
    resolve_link,
    unknown_sources,
)

HOST_1, HOST_2 = "https://www.eltiempo.com", "https://www.elespectador.com"

STORY_CARDS = """
<article class="story-card"><h2 class="article-title">Uno &amp; dos</h2>
  <a class="title page-link" href="/uno">ver</a><span class="category">Bogotá</span></article>
<article class="big listing-card x"><h3 class="my-title">Tres</h3>
  <a class="story-link" href="https://otro.co/tres">ver</a></article>
<article class="listing-card"><h2 class="title">Sin enlace</h2><a class="title">x</a></article>
<article class="listing-card"><h2 class="title">Enlace vacío</h2><a class="title" href="">x</a></article>
<article class="story-card"><h2>Sin clase</h2><a class="title" href="/y">y</a></article>
<article><h2 class="title">Artículo sin clase</h2><a class="title" href="/z">z</a></article>
"""
CARD_CONTAINERS = """
<article class="a Card-Container-Main b"><h2 class="Card-Title">Primero</h2>
  <a class="Card-Title" href="/p">p</a><span class="Card-Category">Judicial</span></article>
<article class="Card-Container"><h2 class="Card-Title">N/A</h2><a class="Card-Title" href="/q">q</a></article>
<article class="Card-Container"><h2 class="Card-Title"> </h2><a class="Card-Title" href="/r">r</a></article>
<article class="Card-Container"><h2 class="Card-Title">Sin enlace</h2></article>
"""
CARDS = """
<div class="BlockContainer-Content">
  <div class="Card-SectionContainer"><span>Suscriptores</span><span>Fútbol Colombiano</span></div>
  <h2 class="Card-Title">Afuera</h2><div class="Card-Hook">Gancho</div>
  <div class="x BlockContainer-Content"><h2 class="Card-Title">Adentro</h2></div>
</div>
<div class="BlockContainer-Content"><div class="Card-Hook">Sin título</div></div>
<div class="BlockContainer-ContentX"><h2 class="Card-Title">Otra clase</h2></div>
"""
LISTING = """
<article class="c-article big" data-seccion=" Deportes "><h3 class="c-article__title">
  <a href=" /gol ">Gol</a></h3></article>
<article class="c-article"><h3 class="c-article__title"><a href="http://x.co/a">Absoluto</a></h3></article>
<article class="c-article" data-seccion=""><h3 class="c-article__title"><a href="">Vacío</a></h3></article>
<article class="c-article"><h3 class="c-article__title"><a>Sin href</a></h3></article>
<article class="c-article"><h3 class="c-article__title">Sin enlace</h3></article>
"""
ARCHIVE = """
<a href="/fuera"><div class="BlockContainer-Content"><h2 class="Card-Title">Fuera</h2></div></a>
<div class="BlockContainer-Content"><a href="https://x.co/b"><h2 class="Card-Title">Dentro</h2></a></div>
<div class="BlockContainer-Content"><h2 class="Card-Title"><a href="/hijo">Hijo</a></h2></div>
<div class="BlockContainer-Content"><a href=""><h2 class="Card-Title">Vacío</h2></a>
  <div class="Card-SectionContainer">Mundo</div></div>
"""


def rows(spark, html, rules, *columns):
    pages = spark.createDataFrame([(html,)], "html string")
    found = extract_headlines(pages, rules).orderBy("pos").select(*columns)
    return [tuple(row) for row in found.collect()]


def test_story_cards(spark):
    assert rows(spark, STORY_CARDS, R.STORY_CARDS, "pos", "category", "title", "link") == [
        (0, "Bogotá", "Uno & dos", HOST_1 + "/uno"),
        (1, "N/A", "Tres", HOST_1 + "https://otro.co/tres"),
    ]


def test_card_containers(spark):
    assert rows(spark, CARD_CONTAINERS, R.CARD_CONTAINERS, "category", "title", "link") == [
        ("Judicial", "Primero", "/p"),
        ("N/A", "", "/r"),
    ]


def test_block_cards(spark):
    assert rows(spark, CARDS, R.BLOCK_CARDS, "category", "title", "description") == [
        ("SuscriptoresFútbol Colombiano", "Afuera", "Gancho"),
        ("No category", "Adentro", "No description"),
    ]


def test_listed_articles(spark):
    assert rows(spark, LISTING, R.LISTED_ARTICLES, "category", "title", "link") == [
        ("Deportes", "Gol", HOST_1 + "/gol"),
        ("No category", "Absoluto", "http://x.co/a"),
        ("", "Vacío", ""),
        ("No category", "Sin href", "No link"),
    ]


def test_archive_cards(spark):
    assert rows(spark, ARCHIVE, R.ARCHIVE_CARDS, "category", "title", "link") == [
        ("No category", "Fuera", HOST_2 + "/fuera"),
        ("No category", "Dentro", "https://x.co/b"),
        ("No category", "Hijo", "No link"),
        ("Mundo", "Vacío", HOST_2),
    ]


def test_dispatch_by_source(spark):
    pages = spark.createDataFrame(
        [("eltiempo", STORY_CARDS), ("elespectador", CARD_CONTAINERS), ("otro", CARDS)],
        "source string, html string",
    )
    found = extract_headlines(pages, R.DAILY_SOURCES).groupBy("source").count().collect()
    assert {row.source: row["count"] for row in found} == {"eltiempo": 2, "elespectador": 2}
    assert [row.source for row in unknown_sources(pages, R.DAILY_SOURCES).collect()] == ["otro"]


def test_pages_without_items_count_zero(spark):
    pages = spark.createDataFrame([("e", "<p>nada</p>"), ("c", CARDS), ("n", None)], "key string, html string")
    counted = parse_pages(pages, R.BLOCK_CARDS).select("key", headline_count().alias("n"))
    assert dict(map(tuple, counted.collect())) == {"e": 0, "c": 2, "n": 0}
    assert extract_headlines(pages, R.BLOCK_CARDS).count() == 2


def test_a_page_that_cannot_be_read(spark, monkeypatch):
    from presslake.operators import extract

    def broken(markup, rules):
        if "bad" in markup:
            raise ValueError("no good")
        return [{"category": None, "title": "t", "link": None, "description": None}]

    monkeypatch.setattr(extract, "read_items", broken)
    pages = spark.createDataFrame([("a", "bad"), ("b", "fine")], "key string, html string")
    parsed = {row.key: row.error for row in parse_pages(pages, R.BLOCK_CARDS).collect()}
    assert parsed == {"a": "ValueError: no good", "b": None}
    assert [row.key for row in extract_headlines(pages, R.BLOCK_CARDS).collect()] == ["b"]
    with pytest.raises(Exception, match="no good"):
        extract_headlines(pages, R.BLOCK_CARDS, mode="FAILFAST").collect()


def test_workers_need_not_have_the_package(tmp_path):
    """Run from another folder, where Python workers cannot import this package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from presslake.operators.extract import extract_headlines
from presslake.operators.rules import BLOCK_CARDS
from presslake.session import local_session
spark = local_session(1)
pages = spark.createDataFrame([({CARDS!r},)], "html string")
print("found", extract_headlines(pages, BLOCK_CARDS).count())
spark.stop()
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True,
        timeout=300,
    )
    assert "found 2" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize(
    "href, prefix, as_is, absolute, blank_is_host",
    [
        ("/a", "H/a", "/a", "H/a", "H/a"),
        ("http://b", "Hhttp://b", "http://b", "http://b", "http://b"),
        ("", "none", "none", "", "H"),
        (None, "none", "none", "none", "none"),
        ("none", "Hnone", "none", "none", "none"),
    ],
)
def test_link_modes(spark, href, prefix, as_is, absolute, blank_is_host):
    frame = spark.createDataFrame([(href,)], "href string")
    modes = (R.PREFIX, R.AS_IS, R.ABSOLUTE, R.ABSOLUTE_BLANK_IS_HOST)
    links = [resolve_link(F.col("href"), F.lit(m), F.lit("H"), F.lit("none")) for m in modes]
    assert tuple(frame.select(*links).first()) == (prefix, as_is, absolute, blank_is_host)


def test_final_columns(spark):
    pages = spark.createDataFrame([(STORY_CARDS,)], "html string")
    found = final_columns(extract_headlines(pages, R.STORY_CARDS), as_of="2025-05-26 06:30:00")
    assert found.columns == ["categoria", "titular", "enlace", "fecha_extraccion"]
    assert found.first().fecha_extraccion == "2025-05-26 06:30:00"


def test_each_page_is_read_once(spark):
    pages = spark.createDataFrame([(CARDS,)], "html string")
    plan = extract_headlines(pages, R.BLOCK_CARDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange hashpartitioning" not in plan
