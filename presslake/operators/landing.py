"""Landing fetched pages: their keys, how each fetch went, a line per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.clock import as_of_column
from presslake.functions.keys import raw_key
from presslake.functions.outcomes import FETCHED, OTHER_ERROR, outcome_message


def landed_pages(fetches: DataFrame, as_of=None) -> DataFrame:
    """The pages of the fetches that went well, with key, source and date.

    ``fetches`` has ``source``, ``outcome``, ``error`` and ``html``. A source has
    one page a day: of several fetches that went well the one whose page has the
    greatest MD5 digest stays. Digests are compared, pages are not moved for it.
    """
    fetched = fetches.filter((F.col("outcome") == FETCHED) & F.col("html").isNotNull())
    pages = fetched.select("source", "html", F.md5("html").alias("digest"))
    chosen = pages.groupBy("source").agg(F.max("digest").alias("digest"))
    kept = pages.join(chosen, ["source", "digest"], "left_semi").dropDuplicates(["source"])
    return kept.select(
        raw_key(F.col("source"), as_of).alias("key"),
        "html",
        "source",
        F.date_format(as_of_column(as_of), "yyyy-MM-dd").alias("date"),
    )


def fetch_outcomes(fetches: DataFrame, *keep: str, as_of=None) -> DataFrame:
    """One message per fetch; a failed one does not stop the others."""
    message = outcome_message(
        F.col("outcome"), F.col("source"), raw_key(F.col("source"), as_of), F.col("error")
    )
    return fetches.select(*keep, "source", message.alias("message"))


def landing_outcomes(fetches: DataFrame, written: DataFrame) -> DataFrame:
    """Fetches with the fate of their pages: one that could not be written has
    failed too. ``written`` is what writing the page files returned."""
    failed = fetches.filter(F.col("outcome") != FETCHED).select("source", "outcome", "error")
    outcome = F.when(F.col("error").isNull(), FETCHED).otherwise(OTHER_ERROR)
    return failed.unionByName(written.select("source", outcome.alias("outcome"), "error"))


def outcome_summary(
    outcomes: DataFrame, order: str | Column, batch: Sequence[str] = ()
) -> DataFrame:
    """The messages of a batch in ``order``, joined by ``"; "``.

    A batch holds one message per source, so its line is as short as the list
    of sources.
    """
    order = F.col(order) if isinstance(order, str) else order
    entries = F.array_sort(F.collect_list(F.struct(order.alias("pos"), F.col("message"))))
    grouped = outcomes.groupBy(*batch).agg(entries.alias("entries"))
    return grouped.select(*batch, F.array_join("entries.message", "; ").alias("summary"))
