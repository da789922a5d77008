"""From raw pages to the headline tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.clock import stamp
from presslake.functions.keys import (
    FINAL_PREFIX,
    PROCESSED_PREFIX,
    RAW_PREFIX,
    final_key,
    key_error,
    page_final_key,
    partition_fields,
    processed_key,
)
from presslake.operators.catalog import register_final, register_written
from presslake.operators.collisions import KEEP_ALL, LAST, last_writers
from presslake.operators.compaction import partition_folder
from presslake.operators.extract import (
    PERMISSIVE,
    RULE_COLUMNS,
    final_columns,
    headline_array,
    headline_count,
    headline_rows,
    parse_pages,
    unknown_sources,
    with_source,
)
from presslake.operators.rules import BLOCK_CARDS, DAILY_SOURCES, RuleSet
from presslake.schemas import FINAL_HEADLINE, FINAL_PARTITIONS, PROCESSED_HEADLINE
from presslake.session import materialize
from presslake.sinks.tables import CSV_DIALECT, FINAL_DIALECT, csv_body, store_objects
from presslake.sources.pages import qualified_root, read_event_pages, scan_pages


def partitioned_files(
    pages: DataFrame, rules: Mapping[str, RuleSet], mode: str = PERMISSIVE
) -> DataFrame:
    """Pages read by the rules of their key's source; what cannot be placed in a
    partition carries an error."""
    files = parse_pages(with_source(pages), rules, mode)
    return files.withColumn("error", F.coalesce("error", key_error(F.col("key"))))


def placed_headlines(
    files: DataFrame, as_of=None, on_collision: str = KEEP_ALL
) -> DataFrame:
    """The final table's rows, with partition columns, of ``partitioned_files``."""
    if on_collision not in (KEEP_ALL, LAST):
        raise ValueError(f"on_collision is {KEEP_ALL!r} or {LAST!r}, not {on_collision!r}")
    good = files.filter(F.col("error").isNull())
    if on_collision == LAST:
        # Stored, as it is read twice and reading the pages is the costly step.
        good = last_writers(materialize(good.filter(headline_count() > 0), "parsed"), as_of)
    fields = partition_fields(F.col("key"), as_of)
    placed = good.select(
        *[value.alias(name) for name, value in fields.items()], *RULE_COLUMNS, "items"
    )
    return final_columns(headline_rows(placed), *FINAL_PARTITIONS, as_of=as_of).select(
        "categoria", "titular", "enlace", "fecha_extraccion", *FINAL_PARTITIONS
    )


def final_objects(files: DataFrame, as_of=None, on_collision: str = KEEP_ALL) -> DataFrame:
    """The final table's files of ``partitioned_files``: ``key`` and ``body``.

    Every page has a file of its own, so writing some pages again replaces just
    their rows; with ``last`` the pages of a source and day share one file, which
    the greatest key fills. A table should be kept in one of the two ways.
    """
    if on_collision not in (KEEP_ALL, LAST):
        raise ValueError(f"on_collision is {KEEP_ALL!r} or {LAST!r}, not {on_collision!r}")
    bodies = headline_bodies(files, as_of)
    if on_collision == LAST:
        return last_writers(materialize(bodies, "bodies"), as_of).select(F.col("final_key").alias("key"), "body")
    return bodies.select(page_final_key(F.col("key"), as_of).alias("key"), "body")


def headline_bodies(files: DataFrame, as_of=None) -> DataFrame:
    """The text of the final table's file for each page with headlines, by the page's ``key``."""
    good = files.filter(F.col("error").isNull() & (headline_count() > 0))
    rows = F.transform(
        headline_array(), lambda h: F.struct(h["category"], h["title"], h["link"], stamp(as_of))
    )
    return good.select("key", csv_body(rows, FINAL_HEADLINE.names, FINAL_DIALECT).alias("body"))


def processed_objects(pages: DataFrame, rules: RuleSet, mode: str = PERMISSIVE) -> DataFrame:
    """The processed headlines' files, one for each page that has any."""
    parsed = parse_pages(pages, rules, mode).filter(headline_count() > 0)
    rows = F.transform(
        headline_array(), lambda h: F.struct(*[h[name] for name in PROCESSED_HEADLINE.names])
    )
    body = csv_body(rows, PROCESSED_HEADLINE.names, CSV_DIALECT)
    return parsed.select(processed_key(F.col("key")).alias("key"), body.alias("body"))


class Published(NamedTuple):
    """Where the table lies, and how the pages fared.

    ``files`` has a row per page of a known source: its headlines counted, or
    the error that kept it out.
    """

    location: str
    files: DataFrame
    unknown_sources: DataFrame


def written_places(files: DataFrame, root: str, as_of=None) -> dict[tuple[str, ...], str]:
    """The partitions that have files of ``partitioned_files``, and their folders: a
    row for each source and day of a run comes to the driver."""
    base = qualified_root(files.sparkSession, root)
    good = files.filter(F.col("error").isNull() & (headline_count() > 0))
    fields = partition_fields(F.col("key"), as_of)
    found = good.select(*[value.alias(name) for name, value in fields.items()]).distinct().collect()
    return {tuple(row): f"{base}/{partition_folder(row)}" for row in found}


def publish_final(
    spark: SparkSession,
    root: str,
    rules: Mapping[str, RuleSet] = DAILY_SOURCES,
    as_of=None,
    on_collision: str = KEEP_ALL,
    table: str | None = None,
    mode: str = PERMISSIVE,
    pages: DataFrame | None = None,
    prefix: str = RAW_PREFIX,
) -> Published:
    """Read every raw page below ``prefix`` of ``root``, or ``pages`` landed
    elsewhere, write their files of the final table, catalogue it.

    Pages that are not read keep their rows. Reading the pages is the costly
    step, so what was read is stored, a small part of the pages' size, and both
    results come from there.
    """
    pages = scan_pages(spark, root, prefix, mode) if pages is None else pages
    location = f"{root.rstrip('/')}/{FINAL_PREFIX}"
    files = materialize(partitioned_files(pages, rules, mode), "parsed")
    store_objects(final_objects(files, as_of, on_collision), root)
    if table is not None:
        if spark.catalog.tableExists(table):
            register_written(spark, table, written_places(files, root, as_of))
        else:
            register_final(spark, table, location)
    fared = files.select("key", "source", headline_count().alias("n_headlines"), "error")
    unknown = unknown_sources(with_source(pages).select("key", "source"), rules)
    return Published(location, fared, unknown)


def publish_processed(
    spark: SparkSession,
    root: str,
    rules: RuleSet = BLOCK_CARDS,
    mode: str = PERMISSIVE,
    pages: DataFrame | None = None,
    prefix: str = RAW_PREFIX,
) -> str:
    """Read every raw page below ``prefix`` of ``root``, or ``pages``, by one rule
    set; write a processed CSV file for each. Pages not read keep theirs."""
    pages = scan_pages(spark, root, prefix, mode) if pages is None else pages
    store_objects(processed_objects(pages, rules, mode), root)
    return f"{root.rstrip('/')}/{PROCESSED_PREFIX}"


def publish_events(
    events: DataFrame,
    root_of_bucket: str,
    root: str,
    rules: RuleSet = BLOCK_CARDS,
    mode: str = PERMISSIVE,
) -> DataFrame:
    """From object notifications to processed CSV: the pages they name are read,
    and no others. Returns what could not be read, with its error."""
    pages = materialize(read_event_pages(events, root_of_bucket, mode=mode), "event_pages")
    good = pages.filter(F.col("error").isNull()).select("key", "html")
    store_objects(processed_objects(good, rules, mode), root)
    return pages.filter(F.col("error").isNotNull()).select("bucket", "key", "error")
