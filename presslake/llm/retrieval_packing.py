"""Packing by lexical retrieval: windows of tokens filled with neighbours of a seed.

Documents are dealt into shards of bounded size, near copies and texts with
the same frequent words together. Each shard has a BM25 inverted index of its
documents, with the word statistics of all documents. Shards are packed one by
one: a seed document opens a window, its best unused neighbours fill the window
in turn, and a document that is cut by the window's end is the next seed. When
no neighbour is left, the next unused document of the shard follows.

The statistics are tables of fixed size: words are hashed to ``2**TERM_BITS``
terms. Texts are shuffled once, to their shards; a task holds one shard.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from presslake.llm.byte_bpe import Encoder
from presslake.llm.counters import summed_table
from presslake.llm.words import blocks, mix, tidy, word_hashes

WINDOW = 2048
END_ID = 1
TERM_BITS = 20
KIN_BITS = 12  # kinds of documents, by the least hashes of their words
SHARD_BYTES = 4 << 20  # of a shard, beyond which a kind is dealt over several
ROW_BYTES = 64  # that a row counts besides its text
K1, B = 1.2, 0.75


class Statistics(NamedTuple):
    """Word statistics of all documents and how kinds of documents are dealt to shards."""

    df: np.ndarray  # documents with a term
    n_docs: int
    n_words: int
    first_shard: np.ndarray  # of each kind
    shards_of: np.ndarray  # number of shards of each kind


def _terms(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of all distinct terms of each row, in that order."""
    row = np.repeat(np.arange(len(rows) - 1, dtype=np.int64), np.diff(rows))
    pairs = (row << TERM_BITS) | (words >> np.uint64(64 - TERM_BITS)).astype(np.int64)
    found, counts = np.unique(pairs, return_counts=True)
    return found >> TERM_BITS, found & ((1 << TERM_BITS) - 1), counts


def _block_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``_terms`` of texts, and the number of words up to each row, block by block."""
    found, ends, first = [], [np.zeros(1, np.int64)], 0
    for block in blocks([pa.RecordBatch.from_arrays([texts], ["text"])], "text"):
        words, rows = word_hashes(block.column(0))
        row, term, count = _terms(words, rows)
        found.append((row + first, term, count))
        ends.append(rows[1:] + ends[-1][-1])
        first += block.num_rows
    row, term, count = (np.concatenate(x) for x in zip(*found))
    return row, term, count, np.concatenate(ends)


def _kinds(texts: pa.Array, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A document's kind: half of the bits from the least hash of all its words,
    which texts of a language tend to share, half from that of a sixteenth of all
    words, which near copies share and few other texts do."""
    kinds = np.zeros(len(rows) - 1, np.int64)
    filled = np.flatnonzero(np.diff(rows) > 0)
    if not len(filled):
        return kinds
    half = np.uint64(64 - KIN_BITS // 2)
    common, rare = mix(words ^ np.uint64(0xA5A5)), mix(words ^ np.uint64(0x5A5A))
    rare = np.where(words & np.uint64(15) == 0, rare >> np.uint64(1), rare | np.uint64(1 << 63))
    starts = rows[:-1][filled]
    first = mix(np.minimum.reduceat(common, starts)) >> half
    second = mix(np.minimum.reduceat(rare, starts)) >> half
    kinds[filled] = (first.astype(np.int64) << (KIN_BITS // 2)) | second.astype(np.int64)
    return kinds


def corpus_statistics(documents: DataFrame, text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Statistics:
    terms, kinds = 1 << TERM_BITS, 1 << KIN_BITS

    def entries(block):
        texts = block.column(text_col)
        words, rows = word_hashes(texts)
        _, term, _ = _terms(words, rows)
        kind = _kinds(texts, words, rows)
        sizes = _sizes(texts)
        place = np.concatenate([term, terms + kind, [terms + kinds, terms + kinds + 1]])
        amount = np.concatenate([np.ones(len(term), np.int64), sizes, [len(sizes), len(words)]])
        return place, amount

    sums = summed_table(documents, text_col, terms + kinds + 2, entries)
    sizes = sums[terms : terms + kinds]
    first, parts = np.zeros(kinds, np.int64), np.ones(kinds, np.int64)
    shard, held = 0, 0
    for kind in range(kinds):
        if held and held + sizes[kind] > shard_bytes:
            shard, held = shard + 1, 0
        first[kind] = shard
        if sizes[kind] > shard_bytes:
            parts[kind] = -(-sizes[kind] // shard_bytes)
            shard, held = shard + int(parts[kind]), 0
        else:
            held += int(sizes[kind])
    return Statistics(sums[:terms], int(sums[terms + kinds]), int(sums[-1]), first, parts)


def _sizes(texts: pa.Array) -> np.ndarray:
    """What rows count in a shard; rows without text count as well."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0)
    return lengths.to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES


def _dealt(rows: DataFrame, statistics: Statistics) -> DataFrame:
    """Rows (``id``, ``text``) with their shard. A kind of several shards deals
    its rows out in turn, so copies of one text cannot fill a shard."""
    carried = rows.sparkSession.sparkContext.broadcast(tuple(statistics))

    def run(batches):
        own, turn = Statistics(*carried.value), 0
        for block in blocks(batches, "text"):
            texts = block.column("text")
            kinds = _kinds(texts, *word_hashes(texts))
            turns = turn + np.arange(len(kinds))
            turn += len(kinds)
            shards = own.first_shard[kinds] + turns % own.shards_of[kinds]
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), texts, pa.array(shards, pa.int64())], ["id", "text", "shard"]
            )

    schema = StructType([rows.schema["id"], rows.schema["text"], StructField("shard", LongType())])
    return rows.mapInArrow(tidy(run), schema)


class Index:
    """BM25 over the documents of a shard: postings by term, and each document's query."""

    def __init__(self, texts: pa.Array, statistics: Statistics):
        row, term, count, ends = _block_terms(texts)
        # Sorted together with their places, terms need no sort by reference.
        order = np.sort((term << 32) | np.arange(len(term)))
        by_term = order & 0xFFFFFFFF
        opens = np.diff(order >> 32, prepend=-1) != 0
        known = order[opens] >> 32
        term[by_term] = np.cumsum(opens) - 1
        self.starts = np.append(np.flatnonzero(opens), len(order))
        local = np.diff(self.starts)
        df = np.maximum(statistics.df[known], local)
        n = max(statistics.n_docs, 1)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        mean = max(statistics.n_words / n, 1.0)
        length = np.diff(ends)[row] / mean
        weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * length))
        self.postings, self.weights = row[by_term], weight[by_term]
        # A row's terms; those no other document of the shard has find nothing.
        shared = local[term] > 1
        self.queries = term[shared]
        self.firsts = np.searchsorted(row[shared], np.arange(len(ends)))

    def neighbours(self, seed: int) -> np.ndarray:
        """Other documents, the best match first; ties by position. All of the seed's
        terms are looked up."""
        terms = self.queries[self.firsts[seed] : self.firsts[seed + 1]]
        if not len(terms):
            return np.empty(0, np.int64)
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in terms]
        places = np.concatenate([self.postings[s] for s in spans])
        scores = np.bincount(places, np.concatenate([self.weights[s] for s in spans]))
        scores[seed] = 0  # the weights of terms are all above 0
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


class Piece(NamedTuple):
    row: int
    start: int
    length: int
    sequence: int
    offset: int


def pack_shard(lengths: np.ndarray, neighbours, window: int = WINDOW) -> list[Piece]:
    """Pieces of a shard's documents; ``neighbours`` lists others for a seed."""
    used = np.zeros(len(lengths), bool)
    pieces: list[Piece] = []
    sequence, filled = 0, 0

    def add(row: int) -> bool:
        """Place a document; whether a window's end cut it or came with its end."""
        nonlocal sequence, filled
        used[row] = True
        start, left, closed = 0, int(lengths[row]), False
        while left:
            taken = min(window - filled, left)
            pieces.append(Piece(row, start, taken, sequence, filled))
            start, left, filled = start + taken, left - taken, filled + taken
            if filled == window:
                sequence, filled, closed = sequence + 1, 0, True
        return closed

    cursor, seed = 0, None
    while True:
        if seed is None:
            while cursor < len(lengths) and used[cursor]:
                cursor += 1
            if cursor == len(lengths):
                return pieces
            seed = cursor
            add(seed)
        if filled == 0:
            seed = None
            continue
        following = None
        near = np.asarray(neighbours(seed), np.int64)
        for row in near[~used[near]]:
            if add(int(row)):
                following = int(row)
                break
        seed = following


def pack_documents(
    documents: DataFrame,
    ranks_path: str,
    json_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per piece of a document: id, ``start``, ``length``, ``ids``,
    ``doc_tokens``, ``sequence_id``, ``offset``.

    A document's ids are those of its whole text and ``end_id``; a null or empty
    text has the latter alone. Pieces are cut only at a window's end, and each id
    is in exactly one of them. ``ids`` holds a piece's ids as little-endian
    unsigned 32-bit numbers. Only the last sequence of a shard may be short.
    Repeated rows are documents of their own, as are rows with null ids. Only id
    and text are read; no rows give no rows. The three paths and the pattern name
    the vocabulary, which every executor must have.
    """
    rows = documents.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    statistics = corpus_statistics(rows, "text", shard_bytes)
    carried = rows.sparkSession.sparkContext.broadcast(tuple(statistics))
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    longs = {name: StructField(name, LongType()) for name in names}
    schema = StructType(
        [rows.schema["id"], longs["start"], longs["length"], StructField("ids", BinaryType()),
         longs["doc_tokens"], longs["sequence_id"], longs["offset"]]
    )

    def pack(shard: int, parts: list[pa.RecordBatch], encode: Encoder):
        table = pa.Table.from_batches(parts).combine_chunks()
        texts = table.column("text").combine_chunks()
        ids = [np.append(own, np.uint32(end_id)).astype("<u4") for own in encode(texts.to_pylist())]
        lengths = np.array([len(own) for own in ids])
        index = Index(texts, Statistics(*carried.value))
        pieces = pack_shard(lengths, index.neighbours, window)
        row, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
        for i in range(0, len(pieces), 1_000):
            some = slice(i, i + 1_000)
            data = [ids[p.row][p.start : p.start + p.length].tobytes() for p in pieces[some]]
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("id").combine_chunks().take(pa.array(row[some])),
                    pa.array(start[some]), pa.array(length[some]), pa.array(data, pa.binary()),
                    pa.array(lengths[row[some]], pa.int64()),
                    pa.array((np.int64(shard) << 32) + sequence[some]), pa.array(offset[some]),
                ],
                names,
            )

    def run(batches):
        encode = Encoder(ranks_path, json_path, pattern)
        shard, parts = None, []
        for batch in batches:
            own = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(own)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(own)]):
                if a == b:
                    continue
                if shard is not None and own[a] != shard:
                    yield from pack(shard, parts, encode)
                    parts = []
                shard = int(own[a])
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from pack(shard, parts, encode)

    shards = _dealt(rows, statistics).repartition("shard").sortWithinPartitions("shard", "id")
    return shards.mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)
