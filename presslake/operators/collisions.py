"""Several raw files of one source and day share a final key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions.keys import final_key

KEEP_ALL, LAST = "keep_all", "last"


def last_writers(files: DataFrame, as_of=None, key: str = "key") -> DataFrame:
    """Of the files sharing a final key, the one whose raw key is greatest.

    Only keys are compared: each task's are reduced to one per final key before
    the shuffle, so a final key shared by a third of all files costs no more than
    any other, and the winners' files are joined by their keys. ``files`` is read
    twice, so pass a stored table. A key must be a file's own. Files that gave no
    rows must be filtered out before.
    """
    target = final_key(F.col(key), as_of)
    winners = files.groupBy(target.alias("final_key")).agg(F.max(key).alias("_winner"))
    return files.join(winners, files[key] == winners["_winner"]).select("final_key", *files.columns)
