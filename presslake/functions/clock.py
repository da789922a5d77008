"""The one place that decides what "now" is."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of: dt.datetime | str | Column | None = None) -> Column:
    """``as_of`` as a timestamp column; the query's own start time by default."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(as_of))


def stamp(as_of: dt.datetime | str | Column | None = None) -> Column:
    """Extraction timestamp in the form the headline tables carry."""
    return F.date_format(as_of_column(as_of), "yyyy-MM-dd HH:mm:ss")
