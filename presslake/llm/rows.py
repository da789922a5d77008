"""Filtering whole rows by decisions made on narrow ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.session import materialize

COPIES_PER_PART = 1_000_000  # equal rows that one input row writes out
BROADCAST_KEYS = 500_000  # keys up to this number are broadcast: some 50 MB at most


def text_key(column: str = "text"):
    return F.xxhash64(F.col(column))


def without(documents: DataFrame, rejected: DataFrame, keys: dict) -> DataFrame:
    """The rows of ``documents`` whose keys no row of ``rejected`` has; nulls are equal.

    ``keys`` gives the expression over ``documents`` for each column of
    ``rejected``. Beyond the bound the keys are not broadcast but shuffled with
    the documents.
    """
    named = materialize(
        rejected.select(*[F.col(name).alias(f"_{name}") for name in keys]).distinct(), "rejected"
    )
    side = F.broadcast(named) if named.count() <= BROADCAST_KEYS else named
    same = F.lit(True)
    for name, value in keys.items():
        same = same & value.eqNullSafe(F.col(f"_{name}"))
    return documents.join(side, same, "left_anti")


def numbered_copies(rows: DataFrame, count: str, number: str, many: bool) -> DataFrame:
    """Every row as often as its ``count`` says, its copies numbered from 1.

    ``many`` tells that some count is above ``COPIES_PER_PART``: such a row is cut
    into parts that are dealt over the tasks before they are written out.
    """
    last = F.floor((F.col(count) - 1) / COPIES_PER_PART)
    parts = rows.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    if many:
        parts = parts.repartition(F.xxhash64(*rows.columns, "_part"))
    first = F.col("_part") * COPIES_PER_PART + 1
    until = F.least(F.col(count), first + COPIES_PER_PART - 1)
    return parts.withColumn(number, F.explode(F.sequence(first, until))).drop("_part")
