"""A bounded, reproducible sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(row_id: Column, folds: int) -> Column:
    """CRC-32 of the id's decimal text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(row_id.cast("string").cast("binary")), F.lit(folds))


class Labelled(NamedTuple):
    text: str
    label: object


LEAST_TEXTS = 10  # a text longer than this part of its label's share waits for the others


def within_budget(sizes: dict[object, list[int]], max_chars: int) -> dict[object, list[int]]:
    """For each label the places in its list of ``sizes`` that are taken, ``max_chars`` in all.

    Labels have equal shares, and what a label has no use for is shared by the
    others. A label's texts are taken in order as they fit; those longer than a
    ``LEAST_TEXTS``-th of its share come after all others.
    """
    left, out = max_chars, {}
    order = sorted(sizes, key=lambda label: (sum(sizes[label]), repr(label)))
    for done, label in enumerate(order):
        own, share = sizes[label], left // (len(order) - done)
        used, taken = 0, []
        for i in sorted(range(len(own)), key=lambda i: own[i] * LEAST_TEXTS > share):
            if 0 < own[i] <= share - used:
                used += own[i]
                taken.append(i)
        left -= used
        out[label] = sorted(taken)
    return out


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    per_label: int,
    max_chars: int,
    seed: int = 17,
) -> list[Labelled]:
    """At most ``per_label`` whole texts of each label, ``max_chars`` characters in all,
    of which each label has an equal share as far as it has use for it.

    ``labels`` holds (id, label); rows with a null in either are not used, and an
    id with several labels counts with the greatest. If it holds texts too, a row's
    text goes with that row's own label; else any text of the id does. Rows are taken in the order
    of a keyed hash of their id, so the sample does not depend on partitioning.
    Only ids and labels are read to choose it; texts are read for the chosen
    rows alone. A text that would exceed the characters left is passed over, and long
    texts come after the others of their label (``within_budget``).
    """
    spark = documents.sparkSession
    own = text_col in labels.columns
    key = F.xxhash64(F.col(text_col)) if own else F.lit(0).cast("bigint")
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), key.alias("_key"))
        .dropna()
        .groupBy("_id")
        .agg(F.max(F.struct("_label", "_key")).alias("_row"))
        .select("_id", "_row._label", "_row._key")
    )
    counts = {row[0]: row[1] for row in known.groupBy("_label").count().collect()}
    place = F.xxhash64(F.lit(seed), F.col("_id").cast("string"))
    # A third more than wanted is expected below the threshold; the rest is cut here.
    chosen = F.lit(False)
    for label, n in sorted(counts.items(), key=repr):
        share = min(1.0, (1.3 * per_label + 30) / n)
        bound = int(-(2**63) + share * (2**64 - 1))
        chosen = chosen | ((F.col("_label") == F.lit(label)) & (place <= F.lit(min(bound, 2**63 - 1))))
    picked = sorted(known.filter(chosen).select(place.alias("p"), "_id", "_label", "_key").collect(), key=lambda r: (r.p, repr(r._id)))
    kept: dict = {}
    taken = dict.fromkeys(counts, 0)
    for row in picked:
        if taken[row._label] < per_label:
            taken[row._label] += 1
            kept[row._id] = row
    if not kept:
        return []
    ids = spark.createDataFrame(
        [(row._id, row._label, row._key, row.p) for row in kept.values()],
        f"_id {known.schema['_id'].dataType.simpleString()}, "
        f"_label {known.schema['_label'].dataType.simpleString()}, _key bigint, _p bigint",
    )
    texts = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.join(F.broadcast(ids), "_id")  # per_label rows a label at most
    if own:
        texts = texts.filter(F.xxhash64("_text") == F.col("_key"))
    size = F.coalesce(F.length("_text"), F.lit(0))
    sizes = texts.groupBy("_id", "_label", "_p").agg(F.max(size).alias("n")).collect()
    by_label: dict = {}
    for row in sorted(sizes, key=lambda r: (r._p, repr(r._id))):
        by_label.setdefault(row._label, []).append(row)
    taken_of = within_budget({label: [r.n for r in some] for label, some in by_label.items()}, max_chars)
    fitting = [by_label[label][i]._id for label, some in taken_of.items() for i in some]
    rows = (
        texts.filter(F.col("_id").isin(fitting))
        .groupBy("_id", "_label", "_p")
        .agg(F.max("_text").alias("_text"))
        .collect()
        if fitting
        else []
    )
    rows.sort(key=lambda r: (r._p, repr(r._id)))
    return [Labelled(r._text, r._label) for r in rows]
