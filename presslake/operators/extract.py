"""Headline extraction: pages in, headline rows out.

The plan is ``pages -> broadcast join with the rules -> one Arrow UDF ->
column expressions -> explode``. Nothing is shuffled, and the same functions
take a batch or a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.clock import stamp
from presslake.functions.keys import source_of
from presslake.operators.outline import read_items
from presslake.operators.rules import (
    ABSOLUTE,
    ABSOLUTE_BLANK_IS_HOST,
    AS_IS,
    PREFIX,
    Field,
    RuleSet,
)

PERMISSIVE, FAILFAST = "PERMISSIVE", "FAILFAST"

_FIELDS = ("category", "title", "link", "description")
RULE_COLUMNS = (
    "rule", "link_mode", "base_url", "require_link", *[f"no_{name}" for name in _FIELDS],
)
_PARSED_DDL = (
    "items array<struct<category: string, title: string, link: string, description: string>>, "
    "error string"
)
_PARSED = pa.struct(
    [
        ("items", pa.list_(pa.struct([(name, pa.string()) for name in _FIELDS]))),
        ("error", pa.string()),
    ]
)


def _rule_values(rule: RuleSet) -> dict:
    """What the column expressions need of a rule set."""
    fields = {name: getattr(rule, name) for name in _FIELDS}
    return {
        "rule": rule.name,
        "link_mode": rule.link_mode,
        "base_url": rule.base_url,
        "require_link": rule.require_link,
        **{f"no_{name}": field.missing if field else None for name, field in fields.items()},
    }


def rules_table(spark, rules: Mapping[str, RuleSet]) -> DataFrame:
    """The rules as a table, one row per source."""
    rows = [{"source": source, **_rule_values(rule)} for source, rule in rules.items()]
    schema = pa.schema(
        [("source", pa.string()), ("rule", pa.string()), ("link_mode", pa.string())]
        + [("base_url", pa.string()), ("require_link", pa.bool_())]
        + [(f"no_{name}", pa.string()) for name in _FIELDS]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def with_source(pages: DataFrame) -> DataFrame:
    return pages.withColumn("source", source_of(F.col("key")))


def dispatch(pages: DataFrame, rules: Mapping[str, RuleSet] | RuleSet) -> DataFrame:
    """Give each page the rules of its ``source``; pages of other sources drop out.

    The rules are code, a row per source, so broadcasting them is safe. A single
    rule set holds for every page.
    """
    if isinstance(rules, RuleSet):
        types = {"require_link": "boolean"}
        values = _rule_values(rules).items()
        return pages.withColumns(
            {name: F.lit(value).cast(types.get(name, "string")) for name, value in values}
        )
    return pages.join(F.broadcast(rules_table(pages.sparkSession, rules)), "source")


def unknown_sources(pages: DataFrame, rules: Mapping[str, RuleSet]) -> DataFrame:
    """The pages no rule set is known for."""
    table = rules_table(pages.sparkSession, rules).select("source")
    return pages.join(F.broadcast(table), "source", "left_anti")


def _reader(rules: Mapping[str, RuleSet] | RuleSet, mode: str):
    used = [rules] if isinstance(rules, RuleSet) else rules.values()
    by_name = {rule.name: rule for rule in used}

    def parse(markup: str | None, name: str) -> dict:
        if markup is None:
            return {"items": [], "error": None}
        try:
            return {"items": read_items(markup, by_name[name]), "error": None}
        except Exception as error:
            if mode == FAILFAST:
                raise
            return {"items": [], "error": f"{type(error).__name__}: {error}"}

    @F.arrow_udf(_PARSED_DDL)
    def read_pages(html: pa.Array, rule: pa.Array) -> pa.Array:
        pages = zip(html.to_pylist(), rule.to_pylist())
        return pa.array([parse(markup, name) for markup, name in pages], type=_PARSED)

    return read_pages


def fill(value: Column, missing: Column) -> Column:
    return F.coalesce(value, missing)


def resolve_link(href: Column, mode: Column, base_url: Column, missing: Column) -> Column:
    """A raw href as a link, by link mode; null or missing hrefs give ``missing``."""
    blank = href == ""
    complete = href.startswith("http") | (href == missing)
    return (
        F.when(href.isNull(), missing)
        .when(blank & mode.isin(PREFIX, AS_IS), missing)
        .when(mode == PREFIX, F.concat(base_url, href))
        .when(mode == AS_IS, href)
        .when(blank & (mode == ABSOLUTE), href)
        .when(mode.isin(ABSOLUTE, ABSOLUTE_BLANK_IS_HOST) & complete, href)
        .otherwise(F.concat(base_url, href))
    )


def is_valid(
    title: Column, link: Column, no_title: Column, no_link: Column, require_link: Column
) -> Column:
    """Whether title, and link where the rules require one, are not the fill-in text."""
    linked = ~require_link | F.coalesce(link != no_link, F.lit(False))
    return (title != no_title) & linked


def _finished(item: Column) -> dict[str, Column]:
    """The fields of a raw item, filled in and with its link resolved."""
    fields = {
        name: fill(item[name], F.col(f"no_{name}")) for name in ("category", "title", "description")
    }
    fields["link"] = resolve_link(
        item["link"], F.col("link_mode"), F.col("base_url"), F.col("no_link")
    )
    return fields


def _valid(title: Column, link: Column) -> Column:
    return is_valid(title, link, F.col("no_title"), F.col("no_link"), F.col("require_link"))


def parse_pages(
    pages: DataFrame, rules: Mapping[str, RuleSet] | RuleSet, mode: str = PERMISSIVE
) -> DataFrame:
    """One row per page of a known source, with its raw items as an array.

    ``pages`` has ``html`` and, for rules by source, ``source``; its other
    columns are kept, ``html`` is not. ``error`` says why a page could not be
    read; with ``FAILFAST`` the first such page fails the query.
    """
    kept = [name for name in pages.columns if name not in ("html", "error")]
    earlier = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    # As a generator's output the result is computed once, filters on it stay
    # above, and filters on the columns kept go below the parse.
    read = F.explode_outer(F.array(_reader(rules, mode)(F.col("html"), F.col("rule"))))
    parsed = dispatch(pages, rules).select("*", read.alias("_parsed"))
    return parsed.select(
        *kept,
        *RULE_COLUMNS,
        F.col("_parsed.items").alias("items"),
        F.coalesce(earlier, F.col("_parsed.error")).alias("error"),
    )


def headline_count() -> Column:
    """How many valid headlines a parsed page has."""

    def valid(item: Column) -> Column:
        fields = _finished(item)
        return _valid(fields["title"], fields["link"])

    return F.size(F.filter("items", valid))


def headline_array() -> Column:
    """The valid headlines of a parsed page, as an array of structs."""

    def finished(item: Column) -> Column:
        fields = _finished(item)
        return F.struct(*[fields[name].alias(name) for name in _FIELDS])

    return F.filter(F.transform("items", finished), lambda h: _valid(h["title"], h["link"]))


def headline_rows(parsed: DataFrame) -> DataFrame:
    """The valid headlines of parsed pages as rows; a page without any gives none.

    Fill-in texts come before the validity test, which compares with them.
    """
    kept = [name for name in parsed.columns if name not in (*RULE_COLUMNS, "items", "error")]
    items = parsed.select(*kept, *RULE_COLUMNS, F.posexplode("items").alias("pos", "item"))
    fields = _finished(F.col("item"))
    rows = items.select(*kept, *RULE_COLUMNS, "pos", *[fields[name].alias(name) for name in _FIELDS])
    return rows.filter(_valid(F.col("title"), F.col("link"))).select(*kept, "pos", *_FIELDS)


def extract_headlines(
    pages: DataFrame, rules: Mapping[str, RuleSet] | RuleSet, mode: str = PERMISSIVE
) -> DataFrame:
    return headline_rows(parse_pages(pages, rules, mode))


def final_columns(headlines: DataFrame, *keep: str, as_of=None) -> DataFrame:
    """Headline rows under the names of the final table."""
    return headlines.select(
        *keep,
        F.col("category").alias("categoria"),
        F.col("title").alias("titular"),
        F.col("link").alias("enlace"),
        stamp(as_of).alias("fecha_extraccion"),
    )
