"""Counts over all rows in a table of fixed size, added up by the executors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from presslake.llm.words import blocks, tidy

SLICE = 1 << 14
_CODEC = "zstd"
_SCHEMA = "slice int, counts binary"


def summed_table(
    rows: DataFrame,
    column: str,
    width: int,
    entries: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray | int]],
    finish: Callable[[np.ndarray], np.ndarray] = lambda sums: sums,
) -> np.ndarray:
    """A table of ``width`` sums: ``entries`` gives a block's positions and what to
    add there.

    Every task adds its blocks up in a table of its own; slices of these tables
    are added in tasks again, so what meets anywhere has a fixed size, and only
    the finished slices come to the driver. ``finish`` maps a slice's sums to
    what is kept of them.
    """
    slices = -(-width // SLICE)

    def count(batches):
        table = np.zeros(slices * SLICE, np.int64)
        for block in blocks(batches, column):
            place, amount = entries(block)
            np.add.at(table, place, amount)
        for i, part in enumerate(table.reshape(slices, SLICE)):
            if part.any():
                data = pa.compress(part.astype("<i8").tobytes(), _CODEC, asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([data], pa.binary())], ["slice", "counts"]
                )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(pa.decompress(data, 8 * SLICE, _CODEC, asbytes=True), "<i8")
                sums[i] = sums[i] + part if i in sums else part
        for i, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([finish(part).tobytes()], pa.binary())], ["slice", "counts"]
            )

    empty = finish(np.zeros(SLICE, np.int64))
    found = rows.select(column).mapInArrow(tidy(count), _SCHEMA).repartition("slice").mapInArrow(tidy(add), _SCHEMA)
    out = np.tile(empty, (slices, 1))
    for i, data in found.collect():  # as many slices as the table has
        out[i] = np.frombuffer(data, empty.dtype)
    return out.ravel()[:width]
