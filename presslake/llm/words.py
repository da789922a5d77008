"""Words and word shingles of whole Arrow batches as 64-bit hashes.

All functions work on flat arrays over a block of texts, so that the cost per
byte is a few array operations. Blocks are cut by bytes between rows: memory
does not depend on how many rows a batch has, only on the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_SEEDED = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _SEEDED.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _SEEDED.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_STEP = _SEEDED.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
SHORT = 32  # bytes of a word that are read place by place, all words at once
_PLACED = _BYTE * _PLACE[:SHORT, None]
_INSIDE, _WHITES = (~WHITE).astype(np.uint8).tobytes(), np.flatnonzero(WHITE).astype(np.uint8).tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array (nulls: none) and the offset of each row."""
    column = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches, column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows into blocks of about ``size`` bytes of text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def release() -> None:
    """Give the system back what is free; else a worker process keeps it for its next tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A task's function that gives memory back when it has ended."""

    def tidied(batches):
        yield from run(batches)
        release()

    return tidied


def word_spans(
    data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the number of words up to each row.
    ``apart`` tells of each byte whether it is outside words."""
    return _spans(~apart[data], offsets)


def _spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[1:-1]
    borders = borders[borders < len(inside)]
    first[borders] = inside[borders]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    borders = borders[borders > 0] - 1
    last[borders] = inside[borders]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    texts: pa.Array, lower: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, in order, and where each row's words start.

    Words are runs without ASCII white space; ``lower`` folds A to Z.
    """
    data, offsets = text_bytes(texts)
    raw = data.tobytes()
    starts, ends, rows = _spans(np.frombuffer(raw.translate(_INSIDE), bool), offsets)
    if not len(starts):
        return np.empty(0, np.uint64), rows
    letters = raw.translate(LOWER.tobytes() if lower else None, _WHITES)
    return span_hashes(np.frombuffer(letters, np.uint8), ends - starts), rows


def span_hashes(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of byte strings that stand one after another, none of them empty."""
    first = np.cumsum(lengths) - lengths
    sums = np.empty(len(lengths), np.uint64)
    # The longest first, so that the words that reach a place are the first ones.
    order = np.argsort(SHORT + 1 - np.minimum(lengths, SHORT + 1).astype(np.uint8), kind="stable")
    reach = len(order) - np.cumsum(np.bincount(np.minimum(lengths, SHORT + 1), minlength=SHORT + 2))
    longer, order = order[: reach[SHORT]], order[reach[SHORT] :]
    at, own = first[order], np.zeros(len(order), np.uint64)
    for place in range(SHORT):
        n = reach[place] - reach[SHORT]
        if not n:
            break
        own[:n] += _PLACED[place][letters[at[:n]]]
        at[:n] += 1
    sums[order] = own
    if len(longer):
        ends = np.cumsum(lengths[longer])
        place = np.arange(ends[-1]) - np.repeat(ends - lengths[longer], lengths[longer])
        signs = letters[np.repeat(first[longer], lengths[longer]) + place]
        sums[longer] = np.add.reduceat(_BYTE[signs] * _PLACE[place & 4095], ends - lengths[longer])
    return mix(sums + lengths.astype(np.uint64))


def shingle_hashes(
    words: np.ndarray, rows: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each row, repeats included.

    A row with fewer words has its whole sequence as its only shingle; a row
    without words has none.
    """
    counts = np.diff(rows)
    whole = np.maximum(counts - size + 1, 0)
    n = max(len(words) - size + 1, 0)
    summed = np.zeros(n, np.uint64)
    for i in range(size):
        summed += words[i : i + n] * _STEP[i]
    short = np.flatnonzero((counts > 0) & (counts < size))
    taken = np.where((counts > 0) & (counts < size), 1, whole)
    starts = np.concatenate([[0], np.cumsum(taken)])
    out = np.empty(starts[-1], np.uint64)
    place = np.arange(starts[-1]) - np.repeat(starts[:-1], taken) + np.repeat(rows[:-1], taken)
    fits = np.repeat(whole > 0, taken)
    out[fits] = summed[place[fits]]
    for row in short:
        own = words[rows[row] : rows[row + 1]]
        out[starts[row]] = (np.append(own, np.uint64(len(own))) * _STEP[: len(own) + 1]).sum()
    return mix(out), starts
