"""How filters interact: what each removes in every order they may be applied in.

A counting Bloom filter finds the texts that may repeat. Every task counts its
texts in a sketch of its own (counters that stop at 2, as two bitmaps); tasks
add slices of the sketches up, and a text one of whose counters stands at 1 is
unique for certain. Only the others are shuffled, whole, for the least id of
each text. The flags of a document are a mask of five bits; masks are counted
per part of the corpus and by label, and as counts add up, all orders of the
filters follow from these few rows.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.words import mix
from presslake.session import materialize

FILTERS = "ABCDE"
LEAST_WORDS = 200  # A
LEAST_DISTINCT = 50  # B, in hundredths of the words
MOST_CAPITALS = 3  # C, in hundredths of the characters
SYMBOLS = r"[#$%&*|]"  # D

HASHES = 4  # counters of a text
CELLS_PER_TEXT = 16
# Counters of a sketch: 64 MB for a task's bitmap and for the one that is broadcast at
# most. Beyond some 100 million texts the sketch clears fewer of the unique ones;
# more texts are shuffled then, and the result is the same.
LEAST_CELLS, MOST_CELLS = 1 << 14, 1 << 29
SLICE_BYTES = 1 << 13
_CODEC = "zstd"


def cells(hashes: np.ndarray, width: int) -> np.ndarray:
    """The counters of each text, a row of ``HASHES`` each; ``width`` is a power of 2."""
    first = mix(hashes.astype(np.int64).view(np.uint64))
    step = mix(first) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)
    return ((first[:, None] + turns * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


class Sketch:
    """Counters that stop at 2: bitmaps of those at 1 or more, and at 2 or more."""

    def __init__(self, width: int):
        self.width = width
        self.once = np.zeros(width // 8, np.uint8)
        self.twice = np.zeros(width // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Count texts; a text whose hashes meet in one counter counts there once."""
        own = np.sort(cells(hashes, self.width), axis=1)
        fresh = np.ones(own.shape, bool)
        fresh[:, 1:] = own[:, 1:] != own[:, :-1]
        found, n = np.unique(own[fresh], return_counts=True)
        bit = np.uint8(1) << (found & 7).astype(np.uint8)
        byte = found >> 3
        again = ((self.once[byte] & bit) != 0) | (n > 1)
        np.bitwise_or.at(self.twice, byte[again], bit[again])
        np.bitwise_or.at(self.once, byte, bit)

    def merge(self, once: np.ndarray, twice: np.ndarray, at: int) -> None:
        part = slice(at, at + len(once))
        self.twice[part] |= twice | (self.once[part] & once)
        self.once[part] |= once


def sketch_width(n_texts: int) -> int:
    wanted = 1 << max(CELLS_PER_TEXT * n_texts - 1, 1).bit_length()
    return min(max(wanted, LEAST_CELLS), MOST_CELLS)


def repeated_cells(hashes: DataFrame, width: int) -> np.ndarray:
    """A bitmap of the counters that stand at 2 or more over all rows of ``hash``."""

    def count(batches):
        own = Sketch(width)
        for batch in batches:
            own.add(batch.column(0).to_numpy(zero_copy_only=False))
        for i in range(0, len(own.once), SLICE_BYTES):
            once, twice = own.once[i : i + SLICE_BYTES], own.twice[i : i + SLICE_BYTES]
            if once.any():
                data = pa.compress(once.tobytes() + twice.tobytes(), _CODEC, asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([data], pa.binary())], ["at", "bits"])

    def add(batches):
        sums: dict[int, Sketch] = {}
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                both = np.frombuffer(pa.decompress(data, 2 * size, _CODEC, asbytes=True), np.uint8)
                sums.setdefault(at, Sketch(8 * size)).merge(both[:size], both[size:], 0)
        for at, sketch in sums.items():
            data = pa.compress(sketch.twice.tobytes(), _CODEC, asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([data], pa.binary())], ["at", "bits"])

    size = min(SLICE_BYTES, width // 8)
    schema = "at bigint, bits binary"
    merged = hashes.mapInArrow(count, schema).repartition("at").mapInArrow(add, schema)
    out = np.zeros(width // 8, np.uint8)
    for at, data in merged.collect():  # width / 8 bytes
        out[at : at + size] = np.frombuffer(pa.decompress(data, size, _CODEC, asbytes=True), np.uint8)
    return out


def may_repeat(hashes: DataFrame, width: int):
    """A column function over text hashes: whether another row may have the text.
    False is certain. Returned with the broadcast it needs."""
    carried = hashes.sparkSession.sparkContext.broadcast(repeated_cells(hashes, width))

    @F.pandas_udf("boolean")
    def suspect(values: pd.Series) -> pd.Series:
        bitmap = carried.value
        own = cells(values.to_numpy(), width)
        return pd.Series(((bitmap[own >> 3] >> (own & 7).astype(np.uint8)) & 1).all(axis=1))

    return suspect, carried


def text_failures(text: Column) -> Column:
    """The mask of filters A to D that a text fails, A in the lowest bit."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def judged(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint")
        failures = (
            n < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)).cast("bigint") < LEAST_DISTINCT * n,
            100 * capitals > MOST_CAPITALS * F.length(text).cast("bigint"),
            text.rlike(SYMBOLS),
        )
        return sum((failed.cast("int") * (1 << i) for i, failed in enumerate(failures)), F.lit(0))

    # A variable, so that the words are found once.
    return F.transform(F.array(words), judged)[0]


def mask_counts(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    quality_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """(``part``, ``mask``, ``good``, ``toxic``, ``n``): documents by the filters they fail.

    A null text counts as empty, a null part as the empty string. A document is
    good if some label of its id has quality 1, toxic if some has toxic 1. Filter
    E fails a row if a row with a lesser id has the same text; a null id is
    neither less nor greater than any and has no labels. Rows that repeat an id
    and its text all count, and none is a repeat of the other. Only the named
    columns are read, so others may have any names. No rows give no rows.

    Rows are shuffled without their texts, equal ones as one; the texts that may
    repeat are shuffled once, each at most once per task. An id whose texts
    differ is told apart by 128 bits of their hashes.
    """
    rows = documents.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    keys = [F.xxhash64("text").alias("key"), F.xxhash64(F.lit(1), "text").alias("key2")]
    suspect, carried = may_repeat(rows.select(F.xxhash64("text").alias("hash")), sketch_width(documents.count()))

    judged = rows.select("id", "part", *keys, text_failures(F.col("text")).alias("mask"))
    flags = judged.withColumn("suspect", suspect(F.col("key")) & F.col("id").isNotNull())
    flags = materialize(flags.groupBy(*flags.columns).agg(F.count("*").alias("n")), "flags")
    suspects = rows.filter(F.col("id").isNotNull()).filter(suspect(F.xxhash64("text")))
    firsts = materialize(
        suspects.groupBy("text").agg(F.min("id").alias("id")).select("id", *keys, F.lit(True).alias("first")), "firsts"
    )
    carried.unpersist()

    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col(quality_col) == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col(toxic_col) == 1, F.lit(False))).alias("toxic"),
    )
    joined = flags.join(firsts, ["id", "key", "key2"], "left").join(marks, "id", "left")
    repeat = F.col("suspect") & F.col("first").isNull()
    mask = F.col("mask") + repeat.cast("int") * (1 << (len(FILTERS) - 1))
    none = F.lit(False)
    return joined.groupBy(
        "part", mask.alias("mask"), F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")
    ).agg(F.sum("n").alias("n"))


def orders(filters: str = FILTERS) -> Column:
    """All steps of all orders: the order, the step, its filter's bit, and the mask of
    the filters before it."""
    bits = {name: 1 << i for i, name in enumerate(filters)}
    steps = [
        {"filter_order": "".join(order), "step": i + 1, "own": bits[order[i]], "before": sum(bits[f] for f in order[:i])}
        for order in permutations(filters)
        for i in range(len(order))
    ]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,own:int,before:int>>")


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What every step of every order does, per part, from ``mask_counts``.

    ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley`` (what the filter removes, summed over all
    orders). Every part that has a document has all steps, zeros included.
    """
    steps = counts.select("*", F.inline(orders(filters)))
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    removed = fails & ~gone
    # Each of the filters that a document fails comes first in as many orders.
    firsts = F.lit(factorial(len(filters))) / F.bit_count("mask")

    def total(condition: Column, of: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, of).otherwise(0)).cast("bigint")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(removed).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        total(fails, F.col("n") * F.floor(firsts)).alias("shapley"),
    )
