"""Large JSON arrays read in parts: one file, many tasks.

A part of a file does not tell whether it begins inside a string, nor how deep.
So every part is first read under both assumptions: how many quotes it has, and
by how much it opens or closes brackets if it begins outside a string, and if
inside. Running sums of these over a file's parts tell how each begins. Then a
part gives the elements that begin in it; the last one is read on into the next
part to its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.schemas import SCRAPED_HEADLINE
from presslake.sources.page_stream import open_store

PART_BYTES = 1 << 25
STEP_BYTES = 1 << 16  # read at a time beyond a part's end
_QUOTE, _ESCAPE, _COMMA = ord('"'), ord("\\"), ord(",")
_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[[ord("["), ord("{")]] = True
_CLOSE[[ord("]"), ord("}")]] = True


def quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes. ``data`` begins outside of an
    escape."""
    back = data == _ESCAPE
    if not back.any():
        return data == _QUOTE
    # A byte is escaped if an odd run of backslashes ends before it.
    place = np.arange(len(data))
    last_other = np.maximum.accumulate(np.where(back, -1, place))
    run = np.where(back, place - last_other, 0)
    escaped = np.concatenate([[False], run[:-1] % 2 == 1])
    return (data == _QUOTE) & ~escaped


def depths(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether it is outside strings, and the change of depth up to it and with it."""
    outside = (np.cumsum(quotes(data)) + inside) % 2 == 0
    return outside, np.cumsum((_OPEN[data] & outside).astype(np.int64) - (_CLOSE[data] & outside))


class Source:
    """Byte ranges of one file."""

    def __init__(self, path: str):
        store, base = open_store(path)
        self._file = store.open_input_file(base)
        self.size = self._file.size()

    def read(self, start: int, stop: int) -> bytes:
        return self._file.read_at(max(min(stop, self.size) - start, 0), start)

    def border(self, at: int) -> int:
        """The first place from ``at`` on that is not next to a backslash, so that no
        escape is cut."""
        while 0 < at < self.size:
            near = np.frombuffer(self.read(at - 1, at + STEP_BYTES), np.uint8) == _ESCAPE
            free = np.flatnonzero(~(near[:-1] | near[1:]))
            if len(free):
                return at + int(free[0])
            at += max(len(near) - 1, 1)
        return min(at, self.size)


def part_summary(source: Source, start: int, stop: int) -> tuple[int, int, int]:
    """Quotes, modulo 2, and the change of depth beginning outside and inside a string."""
    data = np.frombuffer(source.read(source.border(start), source.border(stop)), np.uint8)
    if not len(data):
        return 0, 0, 0
    return int(quotes(data).sum() % 2), int(depths(data, False)[1][-1]), int(depths(data, True)[1][-1])


def part_elements(source: Source, start: int, stop: int, inside: bool, depth: int) -> Iterator[str]:
    """The texts of the array's elements that begin in a part."""
    first, last = source.border(start), source.border(stop)
    data = np.frombuffer(source.read(first, last), np.uint8)
    outside, change = depths(data, inside)
    level = depth + change
    opens = outside & (level == 1) & _OPEN[data] & (data == ord("["))
    # A bracket that closes an element of the array returns to level 1 as well, but is no comma.
    starts = np.flatnonzero(opens | (outside & (level == 1) & (data == _COMMA)))
    ends = np.flatnonzero((outside & (level == 1) & (data == _COMMA)) | (outside & (level == 0) & _CLOSE[data]))
    if not len(starts):
        return
    held = data.tobytes()
    after = np.searchsorted(ends, starts, "right")
    for at, place in zip(starts, after):
        if place < len(ends):
            text = held[at + 1 : ends[place]]
        else:
            text = held[at + 1 :] + _rest(source, last, level[-1], not _ends_outside(data, inside))
        text = text.strip()
        if text:
            yield text.decode("utf-8")


def _ends_outside(data: np.ndarray, inside: bool) -> bool:
    return bool((quotes(data).sum() + inside) % 2 == 0)


def _rest(source: Source, at: int, depth: int, inside: bool) -> bytes:
    """From ``at`` to the end of the element that is open there."""
    out = []
    while at < source.size:
        stop = source.border(at + STEP_BYTES)
        data = np.frombuffer(source.read(at, stop), np.uint8)
        outside, change = depths(data, inside)
        level = depth + change
        ends = np.flatnonzero(outside & (((level == 1) & (data == _COMMA)) | ((level == 0) & _CLOSE[data])))
        if len(ends):
            out.append(data[: ends[0]].tobytes())
            break
        out.append(data.tobytes())
        inside, depth, at = not _ends_outside(data, inside), int(level[-1]), stop
    return b"".join(out)


def json_elements(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(``path``, ``element``): the elements' texts of the JSON arrays in the files at
    ``path``, one array a file. An empty file or array has none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    first = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(part_bytes).cast("bigint"))
    parts = files.filter("length > 0").select("path", F.explode(first).alias("start"))
    # A part is a task's work, whatever files they come from.
    parts = parts.repartition(F.xxhash64("path", "start"))

    def summed(batches):
        for batch in batches:
            rows = batch.to_pylist()
            found = [part_summary(Source(r["path"]), r["start"], r["start"] + part_bytes) for r in rows]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["path", "start", "quotes", "outside", "inside"])

    kind = "path string, start bigint"
    sums = parts.mapInArrow(summed, f"{kind}, quotes bigint, outside bigint, inside bigint")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.withColumn("within", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))
    begun = begun.withColumn("change", change)
    begun = begun.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    placed = begun.select("path", "start", "within", "depth").repartition(F.xxhash64("path", "start"))

    def elements(batches):
        for batch in batches:
            for r in batch.to_pylist():
                found = part_elements(Source(r["path"]), r["start"], r["start"] + part_bytes, r["within"], r["depth"])
                texts = list(found)
                for i in range(0, len(texts), 10_000):
                    some = texts[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["path"]] * len(some), pa.string()), pa.array(some, pa.string())], ["path", "element"]
                    )

    return placed.mapInArrow(elements, "path string, element string")


def scan_json_array(
    spark: SparkSession, path: str, schema: T.StructType = SCRAPED_HEADLINE, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Scraped headlines in JSON arrays of any size. An element that is no object of
    the schema gives nulls."""
    parsed = F.from_json("element", schema)
    return json_elements(spark, path, part_bytes).select(parsed.alias("row")).select("row.*")
