"""The newspapers' own rules over pages in their markup, one for each document.

The test tables hold no newspaper pages, so each document gets one: its number
chooses a form of the markup, and its id and source are the text. Beside each
form stand the rows it must give.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.operators.extract import extract_headlines
from presslake.operators.rules import (
    ARCHIVE_CARDS,
    BLOCK_CARDS,
    CARD_CONTAINERS,
    LISTED_ARTICLES,
    STORY_CARDS,
)
from presslake.queries.registry import query, table

_TIEMPO, _ESPECTADOR = "https://www.eltiempo.com", "https://www.elespectador.com"

# Forms of a page and the (category, title, link, description) of its rows.
STORY_FORMS = [
    ('<article class="x story-card-big"><h2 class="article-title main">A &amp; <b>B{id}</b></h2>'
     '<a class="story-link" href="/n/{id}">more</a><span class="category">{source}</span></article>',
     [("{source}", "A &B{id}", f"{_TIEMPO}/n/{{id}}", None)]),
    ('<article class="listing-card"><h3 class="title">C{id}</h3><a class="title" href="/c">x</a></article>'
     '<article class="story-card"><h3 class="title">D{id}</h3><a href="/no">x</a><a class="title" href="/d">x</a>'
     '<span class="section-name"> S </span></article>',
     [("N/A", "C{id}", f"{_TIEMPO}/c", None), ("S", "D{id}", f"{_TIEMPO}/d", None)]),
    ('<article class="story-card"><a class="title" href="/n">x</a></article>', []),
    ('<article class="story-card"><h2 class="title">E{id}</h2><a class="title">x</a></article>', []),
    ('<article class="story-card"><h2 class="title">F{id}</h2><a class="title" href="">x</a></article>', []),
    ('<article class="story-card"><h2 class="title">G{id}</h2><a class="title" href="https://x.y/{id}">x</a></article>',
     [("N/A", "G{id}", f"{_TIEMPO}https://x.y/{{id}}", None)]),
    ('<article class="other"><h2 class="title">H</h2><a class="title" href="/h">x</a></article>', []),
    ('<article><h2 class="title">I</h2><a class="title" href="/i">x</a></article>', []),
    ('<article class="story-card"><article class="story-card"><h2 class="title">In{id}</h2>'
     '<a class="title" href="/in">x</a></article><h2 class="title">Out</h2><a class="title" href="/out">x</a></article>',
     [("N/A", "In{id}", f"{_TIEMPO}/in", None)] * 2),
    ('<article class="story-card"><h2 class="title">N/A</h2><a class="title" href="/n">x</a></article>', []),
]
CONTAINER_FORMS = [
    ('<article class="Card Card-Container_big"><h2 class="Card-Title">A{id}<br>B</h2>'
     '<a class="Card-Title" href="/n/{id}">x</a><span class="Card-Category">{source}</span></article>',
     [("{source}", "A{id}B", "/n/{id}", None)]),
    ('<article class="Card-Container"><h3 class="Card-Title">no</h3><h2 class="Big Card-Title">C{id}</h2>'
     '<a class="Card-Title" href="https://x.y/">x</a></article>',
     [("N/A", "C{id}", "https://x.y/", None)]),
    ('<article class="Card-Container"><h2 class="Card-Title">D</h2><a class="Card-Title" href="">x</a></article>', []),
    ('<article class="Card-Container"><h2 class="Card-Title">E</h2><a href="/e">x</a></article>', []),
    ('<article class="Card"><h2 class="Card-Title">F</h2><a class="Card-Title" href="/f">x</a></article>', []),
    ('<article class="Card-Container"><h2 class="Card-Title">  </h2><a class="Card-Title" href=" /g{id} ">x</a></article>',
     [("N/A", "", " /g{id} ", None)]),
]
BLOCK_FORMS = [
    ('<div class="Wide BlockContainer-Content"><div class="Card-SectionContainer"><span>{source}</span><span> Y</span></div>'
     '<h2 class="Card-Title">A{id}</h2><div class="Card-Hook">Hook {id}</div></div>',
     [("{source}Y", "A{id}", None, "Hook {id}")]),
    ('<div class="BlockContainer-Content"><div class="BlockContainer-Content"><h2 class="Card-Title">B{id}</h2></div>'
     '<h2 class="Card-Title">C{id}</h2></div>',
     [("No category", "B{id}", None, "No description")] * 2),
    ('<div class="BlockContainer-Content-Big"><h2 class="Card-Title">D</h2></div>', []),
    ('<div class="BlockContainer-Content"><h2 class="Card-Title-Big">E</h2></div>', []),
    ('<div class="BlockContainer-Content"><h2 class="Card-Title">No title</h2></div><p>{id}</p>', []),
    ("<p>{id}</p>", []),
]
LISTED_FORMS = [
    ('<article class="c-article c-article--x" data-seccion=" {source} "><h3 class="c-article__title">'
     '<a href=" /n/{id} ">A<i>B{id}</i></a></h3></article>',
     [("{source}", "AB{id}", f"{_TIEMPO}/n/{{id}}", None)]),
    ('<article class="c-article"><h3 class="c-article__title"><a href="http://x.y/{id}">C{id}</a></h3></article>',
     [("No category", "C{id}", "http://x.y/{id}", None)]),
    ('<article class="c-article"><h3 class="c-article__title"><a href="">D{id}</a></h3></article>',
     [("No category", "D{id}", "", None)]),
    ('<article class="c-article"><h3 class="c-article__title"><a>E{id}</a></h3></article>',
     [("No category", "E{id}", "No link", None)]),
    ('<article class="c-article"><h3 class="c-article__title">F</h3></article>', []),
    ('<article class="article"><h3 class="c-article__title"><a href="/g">G</a></h3></article>', []),
]
ARCHIVE_FORMS = [
    ('<a href="/out/{id}"><div class="BlockContainer-Content"><div class="Card-SectionContainer">{source}</div>'
     '<h2 class="Card-Title">A{id}</h2></div></a>',
     [("{source}", "A{id}", f"{_ESPECTADOR}/out/{{id}}", None)]),
    ('<div class="BlockContainer-Content"><a name="x"><a href=" https://x.y/{id}"><h2 class="Card-Title">B{id}</h2></a></a></div>',
     [("No category", "B{id}", "https://x.y/{id}", None)]),
    ('<div class="BlockContainer-Content"><a href=""><h2 class="Card-Title">C{id}</h2></a></div>',
     [("No category", "C{id}", _ESPECTADOR, None)]),
    ('<div class="BlockContainer-Content"><h2 class="Card-Title"><a href="/in">D{id}</a></h2></div>',
     [("No category", "D{id}", "No link", None)]),
    ('<div class="BlockContainer-Content"><a href="/e"><h2>E</h2></a></div>', []),
    ("<p>{id}</p>", []),
]


def _pages(spark, sf_dir, forms):
    form = F.element_at(F.array(*[F.lit(markup) for markup, _ in forms]), (F.col("doc_id") % len(forms) + 1).cast("int"))
    html = F.replace(F.replace(form, F.lit("{id}"), F.col("doc_id").cast("string")), F.lit("{source}"), F.col("source"))
    return table(spark, sf_dir, "documents").select("doc_id", html.alias("html"))


def _expected(forms) -> str:
    def text(value):
        return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"

    rows = [
        f"({number}, {', '.join(map(text, row))})" for number, (_, found) in enumerate(forms) for row in found
    ]
    columns = ", ".join(
        f"replace(replace({name}, '{{id}}', CAST(doc_id AS VARCHAR)), '{{source}}', source) AS {name}"
        for name in ("category", "title", "link", "description")
    )
    return f"""
    SELECT doc_id, {columns} FROM documents
    JOIN (VALUES {", ".join(rows)}) AS forms(form, category, title, link, description) ON doc_id % {len(forms)} = form
    """


def _extracted(spark, sf_dir, forms, rules):
    return extract_headlines(_pages(spark, sf_dir, forms), rules).drop("pos")


@query(_expected(STORY_FORMS))
def newspaper_story_cards(spark, sf_dir):
    return _extracted(spark, sf_dir, STORY_FORMS, STORY_CARDS)


@query(_expected(CONTAINER_FORMS))
def newspaper_card_containers(spark, sf_dir):
    return _extracted(spark, sf_dir, CONTAINER_FORMS, CARD_CONTAINERS)


@query(_expected(BLOCK_FORMS))
def newspaper_block_cards(spark, sf_dir):
    return _extracted(spark, sf_dir, BLOCK_FORMS, BLOCK_CARDS)


@query(_expected(LISTED_FORMS))
def newspaper_listed_articles(spark, sf_dir):
    return _extracted(spark, sf_dir, LISTED_FORMS, LISTED_ARTICLES)


@query(_expected(ARCHIVE_FORMS))
def newspaper_archive_cards(spark, sf_dir):
    return _extracted(spark, sf_dir, ARCHIVE_FORMS, ARCHIVE_CARDS)
