"""From fetched pages to raw page files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from presslake.operators.landing import fetch_outcomes, landed_pages, landing_outcomes
from presslake.session import materialize
from presslake.sinks.tables import write_page_files


def land_fetches(fetches: DataFrame, root: str, as_of) -> DataFrame:
    """Write the page of every fetch that went well under its source and day;
    returns a message per fetch. A rerun on the same day overwrites.

    ``as_of`` is given, not taken from the clock, so that keys and messages
    agree; the outcome table is written so that pages are written only once.
    """
    written = materialize(write_page_files(landed_pages(fetches, as_of), root), "landed")
    return fetch_outcomes(landing_outcomes(fetches, written), as_of=as_of)
