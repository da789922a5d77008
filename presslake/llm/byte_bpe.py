"""Token ids of whole blocks of text by a byte-level BPE vocabulary.

The vocabulary's own splitting rule is applied to a block of texts at once, and
only the distinct pieces are given to the tokenizer, each once for a worker process.
"""

from __future__ import annotations

import base64
import unicodedata
from itertools import chain

import numpy as np

from presslake.llm.words import mix

_OTHER, _LETTER, _NUMBER, _WHITE = range(4)
# Unicode white space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
_QUOTE, _BLANK = ord("'"), ord(" ")
CACHED = 1_000_000  # pieces a task keeps the ids of
BLOCK_CHARS = 1 << 20  # read at once


class _Classes:
    def __init__(self):
        self._table = np.zeros(0, np.uint8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        top = int(points.max()) + 1 if len(points) else 0
        if top > len(self._table):
            more = np.zeros(top, np.uint8)
            more[: len(self._table)] = self._table
            for i in range(len(self._table), top):
                kind = unicodedata.category(chr(i))[0]
                more[i] = {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
            more[[i for i in WHITE_SPACE if i < top]] = _WHITE
            self._table = more
        return self._table[points]


def piece_starts(points: np.ndarray, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pieces start in which the tokenizer merges bytes.

    ``rows`` are the starts of the texts and their end. Runs of letters, of
    numbers, of other signs and of white space are pieces; one blank before a
    run belongs to it, as do a few English endings to a quote before them.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    opens = np.zeros(n + 1, bool)
    opens[rows] = True
    starts = opens.copy()
    starts[1:n] |= kinds[1:] != kinds[:-1]
    runs = np.flatnonzero(starts)
    begin, end = runs[:-1], runs[1:]
    # The last white-space sign before another run is a piece, or part of the run.
    white = (kinds[begin] == _WHITE) & ~opens[end]
    last = end[white] - 1
    starts[last] = True
    starts[end[white][points[last] == _BLANK]] = False
    # A lone quote and an ending after it.
    lone = (points[begin] == _QUOTE) & (end - begin == 1) & ~opens[end] & (end < n)
    at = begin[lone]
    at = at[opens[at] | (points[at - 1] != _BLANK)]
    at = at[kinds[at + 1] == _LETTER]
    if len(at):
        ends = rows[np.searchsorted(rows, at, "right")]
        one = points[at + 1]
        two = np.where(at + 2 < ends, points[np.minimum(at + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(at), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        taken = np.where(short, 2, np.where(long, 3, 0))
        at, taken = at[taken > 0], taken[taken > 0]
        starts[at + 1] = False
        starts[at + taken] = True
    return np.flatnonzero(starts[:n])


def _merges(ranks_path: str, pattern: str):
    """The vocabulary's merges; kept in the library's own table of encodings, so
    that a worker process reads the file once for all its tasks."""
    import tiktoken
    from tiktoken.registry import ENCODINGS

    name = f"ranks:{ranks_path}:{pattern}"
    if name not in ENCODINGS:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ENCODINGS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return ENCODINGS[name]


def _appended(held: np.ndarray, n: int, added: np.ndarray) -> np.ndarray:
    """The first ``n`` values and ``added`` after them, with room for more."""
    if n + len(added) > len(held):
        held = np.concatenate([held[:n], np.empty(len(added) + n // 2, held.dtype)])
    held[n : n + len(added)] = added
    return held


class _Pieces:
    """Ids of pieces by hash: a table with free places gives a piece's number, and
    the ids of the pieces stand in a pool by number. Number 0 is no piece."""

    def __init__(self):
        self._numbers = np.zeros(1 << 12, np.int32)
        self._hashes, self._ends, self._pool = np.zeros(1, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self._n = 1

    def __len__(self):
        return self._n - 1

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self._numbers) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of pieces, 0 for unknown ones."""
        place = self._first(hashes)
        found = self._numbers[place]
        left = np.flatnonzero((found > 0) & (self._hashes[found] != hashes))
        while len(left):
            place[left] = (place[left] + 1) & (len(self._numbers) - 1)
            here = self._numbers[place[left]]
            found[left] = here
            left = left[(here > 0) & (self._hashes[here] != hashes[left])]
        return found

    def add(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Unknown pieces, each once, with the number of ids of each and all ids."""
        n = self._n
        self._pool = _appended(self._pool, int(self._ends[n - 1]), ids)
        self._ends = _appended(self._ends, n, self._ends[n - 1] + np.cumsum(sizes))
        self._hashes = _appended(self._hashes, n, hashes)
        self._n = n + len(hashes)
        if 2 * self._n > len(self._numbers):
            self._numbers = np.zeros(1 << (2 * self._n).bit_length(), np.int32)
            n = 1
        numbers = np.arange(n, self._n, dtype=np.int32)
        place = self._first(self._hashes[numbers])
        while len(numbers):
            free = self._numbers[place] == 0
            self._numbers[place[free]] = numbers[free]
            lost = self._numbers[place] != numbers
            numbers, place = numbers[lost], (place[lost] + 1) & (len(self._numbers) - 1)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after another, and the number of each one's."""
        stops = self._ends[numbers]
        counts = stops - self._ends[numbers - 1]
        ends = np.cumsum(counts)
        return self._pool[np.arange(ends[-1]) + np.repeat(stops - ends, counts)], counts


class Encoder:
    """Ids of texts as the vocabulary's tokenizer gives them, without special tokens added."""

    def __init__(self, ranks_path: str, json_path: str, pattern: str, special: str = "<|endoftext|>"):
        self._merge = _merges(ranks_path, pattern)
        self._json, self._special, self._whole = json_path, special, None
        self._kinds = _Classes()
        # Kept with the merges, so that a worker process learns a piece once for all its tasks.
        self._pieces = getattr(self._merge, "pieces", None) or self._forget()

    def _forget(self) -> _Pieces:
        self._merge.pieces = self._pieces = _Pieces()
        return self._pieces

    def _by_tokenizer(self, text: str) -> np.ndarray:
        """A text that spells a special token, which the tokenizer reads as that token."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._json)
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Texts are read in blocks: the arrays of a block take some
        hundred times its characters."""
        out: list[np.ndarray] = []
        ends = np.cumsum([len(text) for text in texts])
        while len(out) < len(texts):
            before = ends[len(out) - 1] if out else 0
            stop = max(len(out) + 1, int(np.searchsorted(ends, before + BLOCK_CHARS, "right")))
            out += self._block(texts[len(out) : stop])
        return out

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        plain = ["" if self._special in text else text for text in texts]
        joined = "".join(plain)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        rows = np.cumsum([0, *map(len, plain)])
        starts = piece_starts(points, rows, self._kinds(points))
        flat, counts = self._ids(joined, points, starts)
        firsts = np.concatenate([[0], np.cumsum(counts)])
        cuts = firsts[np.searchsorted(starts, rows)]
        out = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for i, (text, own) in enumerate(zip(texts, plain)):
            if len(text) != len(own):
                out[i] = self._by_tokenizer(text)
        return out

    def _ids(self, joined: str, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        lengths = np.diff(np.append(starts, len(points)))
        place = np.arange(len(points)) - np.repeat(starts, lengths)
        codes = mix(points.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(24)))
        return self._ids_of(joined, mix(np.add.reduceat(codes, starts)), starts, lengths)

    def _ids_of(
        self, joined: str, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        at = self._pieces.find(hashes)
        new = np.flatnonzero(at == 0)
        if len(new):
            found, first = np.unique(hashes[new], return_index=True)
            if len(self._pieces) + len(found) > CACHED and len(self._pieces):
                self._forget()
                return self._ids_of(joined, hashes, starts, lengths)
            self._learn(joined, found, starts[new[first]], lengths[new[first]])
            at[new] = self._pieces.find(hashes[new])
        return self._pieces.ids(at)

    def _learn(self, joined: str, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        merge = self._merge.encode_ordinary
        ids = [merge(joined[a : a + n]) for a, n in zip(starts.tolist(), lengths.tolist())]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self._pieces.add(hashes, sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())))
