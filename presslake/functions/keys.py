"""Object keys: what they say about a page, and the keys derived from them.

All functions map columns to columns and stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.clock import as_of_column

# The key layout.
RAW_PREFIX = "headlines/raw/"
PROCESSED_PREFIX = "headlines/processed/"
FINAL_PREFIX = "headlines/final/"
PAGE_SUFFIX = ".html"
TABLE_SUFFIX = ".csv"
UNKNOWN_SOURCE = "unknown"

# Four, two and two decimal digits; what follows the day is not looked at.
DATE_PREFIX = r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}"


def is_page_key(key: Column) -> Column:
    return key.startswith(RAW_PREFIX) & key.endswith(PAGE_SUFFIX)


def decode_key(key: Column) -> Column:
    """URL-decode a key; ``+`` is a space, a stray ``%`` stands for itself."""
    return F.url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def source_of(key: Column) -> Column:
    return F.coalesce(F.try_element_at(F.split(key, "/"), F.lit(3)), F.lit(UNKNOWN_SOURCE))


def date_segment(key: Column) -> Column:
    """The folder a file lies in; null for a key without folders."""
    return F.try_element_at(F.split(key, "/"), F.lit(-2))


def is_dated(segment: Column) -> Column:
    return F.coalesce(segment.rlike(DATE_PREFIX), F.lit(False))


def file_date(key: Column, as_of=None) -> Column:
    """The dated folder as it stands, else the day of ``as_of``."""
    segment = date_segment(key)
    today = F.date_format(as_of_column(as_of), "yyyy-MM-dd")
    return F.when(is_dated(segment), segment).otherwise(today)


def key_error(key: Column) -> Column:
    """Why no partition can be derived from ``key``; null when one can."""
    segment = date_segment(key)
    return F.when(segment.isNull(), "key has no folder").when(
        is_dated(segment) & (F.size(F.split(segment, "-")) != 3),
        "date folder has more than three parts",
    )


def partition_fields(key: Column, as_of=None) -> dict[str, Column]:
    """The partition values of a key, padding kept, as strings."""
    parts = F.split(file_date(key, as_of), "-")
    return {
        "periodico": source_of(key),
        "year": parts[0],
        "month": parts[1],
        "day": parts[2],
    }


def raw_key(source: Column, as_of=None) -> Column:
    day = F.date_format(as_of_column(as_of), "yyyy-MM-dd")
    return F.concat(
        F.lit(RAW_PREFIX), source, F.lit("/"), day, F.lit("/"), source, F.lit("_"), day,
        F.lit(PAGE_SUFFIX),
    )


def flat_raw_key(source: Column, as_of=None) -> Column:
    """Key of an archive page, told apart by the second it was landed."""
    second = F.date_format(as_of_column(as_of), "yyyyMMddHHmmss")
    return F.concat(
        F.lit(RAW_PREFIX), source, F.lit("_archive_page_1_"), second, F.lit(PAGE_SUFFIX)
    )


def final_key(key: Column, as_of=None) -> Column:
    fields = partition_fields(key, as_of)
    folders = [F.concat(F.lit(f"{name}="), value, F.lit("/")) for name, value in fields.items()]
    return F.concat(
        F.lit(FINAL_PREFIX), *folders, source_of(key), F.lit("_"), file_date(key, as_of),
        F.lit(TABLE_SUFFIX),
    )


def page_final_key(key: Column, as_of=None) -> Column:
    """Key of one page's rows in the final table: its partition's folder, and a
    name that no other page has."""
    folder = F.regexp_replace(final_key(key, as_of), "[^/]*$", "")
    name = F.regexp_replace(F.element_at(F.split(key, "/"), -1), r"\.html$", "")
    return F.concat(folder, name, F.lit("-"), F.substring(F.md5(key), 1, 12), F.lit(TABLE_SUFFIX))


def processed_key(key: Column) -> Column:
    moved = F.replace(key, F.lit(RAW_PREFIX), F.lit(PROCESSED_PREFIX))
    return F.replace(moved, F.lit(PAGE_SUFFIX), F.lit(TABLE_SUFFIX))
