"""Ranked lexical search over bit-sliced Bloom signatures, exact to the last point.

The index holds blocks of documents. A document's signature has bits for each of
its terms, and more for a term that occurs at least 2, 3, 4, 6 ... times; a
block keeps them as slices, one bitmap of its documents for every bit. Joining
the slices of a term gives all documents that may hold it, and those of its
levels a bound on its occurrences, so the weighted sum over an item's terms is
at least the document's score. The best bounds of all blocks are scored exactly
first; every document whose bound reaches the last of an item's ten best scores
so far is scored exactly as well, and nothing else can rank.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator
from math import floor, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.rows import text_key
from presslake.llm.words import LOWER, blocks, mix, span_hashes, text_bytes, word_spans
from presslake.session import materialize

# Bytes outside terms: all of ASCII but digits and letters.
APART = np.ones(256, bool)
APART[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False

LEVELS = np.array([1, 2, 3, 4, 6, 10, 20, 40, 80, 160, 320])  # occurrences that have bits of their own
HASHES = 3
BITS_PER_ENTRY = 10
LEAST_WIDTH, MOST_WIDTH = 1 << 7, 1 << 18  # bits of a signature; beyond, bounds are looser
BLOCK_BITS = 1 << 21
BLOCK_DOCUMENTS = 4096
CELLS = 1 << 22  # numbers in a matrix of terms and documents
ITEMS_PER_BLOCK, TERMS_PER_BLOCK = 256, 20_000  # queries answered together
BROADCAST_CANDIDATES = 200_000  # keys and their few items: some 20 MB


class Terms(NamedTuple):
    codes: np.ndarray  # of every term, in order
    rows: np.ndarray  # where each row's terms start, and the end
    distinct: pa.Array  # the terms that codes stand for, binary


def find_terms(texts: pa.Array) -> Terms:
    """The terms of each text, A to Z lower-cased; a null text has none."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, APART)
    letters = np.ascontiguousarray(data[~APART[data]])
    borders = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    terms = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(letters)]
    ).dictionary_encode()
    return Terms(terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), rows, terms.dictionary)


def term_hashes(terms: pa.Array) -> np.ndarray:
    if not len(terms):
        return np.empty(0, np.uint64)
    terms = terms.cast(pa.large_binary())
    borders = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    return span_hashes(np.frombuffer(terms.buffers()[2], np.uint8)[borders[0] : borders[-1]], np.diff(borders))


def entry_hashes(hashes: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """What stands in a signature for a term that occurs ``LEVELS[level]`` times."""
    return mix(hashes + (np.atleast_1d(level).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def positions(entries: np.ndarray, width: int) -> np.ndarray:
    step = (entries >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)
    return ((entries[:, None] + turns * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


def occurrences(terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and number of each distinct term of each row."""
    row = np.repeat(np.arange(len(terms.rows) - 1), np.diff(terms.rows))
    pairs, n = np.unique(row * len(terms.distinct) + terms.codes, return_counts=True)
    return pairs // max(len(terms.distinct), 1), pairs % max(len(terms.distinct), 1), n


def build_index(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of signatures: ``ids``, ``keys``, ``lengths`` (in terms), ``width`` and ``slices``.

    Every document with a term is in one block, with others whose signatures are
    as wide. No shuffle: blocks are made where the documents are read.
    """
    rows = documents.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    schema_id = rows.schema["id"].dataType.simpleString()

    def block_of(width: int, held: list[tuple]) -> pa.RecordBatch:
        bits = np.zeros((width, -(-len(held) // 8) * 8), bool)
        for column, (_, _, _, entries) in enumerate(held):
            bits[positions(entries, width).ravel(), column] = True
        ids = pa.concat_arrays([h[0] for h in held])
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), ids),
                pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                pa.array([[h[2] for h in held]], pa.list_(pa.int64())),
                pa.array([width], pa.int64()),
                pa.array([np.packbits(bits, axis=1, bitorder="little").tobytes()], pa.binary()),
            ],
            ["ids", "keys", "lengths", "width", "slices"],
        )

    def run(batches):
        waiting: dict[int, list[tuple]] = {}
        for block in blocks(batches, "text"):
            terms = find_terms(block.column("text"))
            row, code, n = occurrences(terms)
            levels = np.searchsorted(LEVELS, n, "right")
            first = np.cumsum(levels) - levels
            level = np.arange(levels.sum()) - np.repeat(first, levels)
            entries = entry_hashes(np.repeat(term_hashes(terms.distinct)[code], levels), level)
            ends = np.searchsorted(np.repeat(row, levels), np.arange(block.num_rows + 1))
            lengths, keys = np.diff(terms.rows), block.column("key").to_pylist()
            for i in np.flatnonzero(lengths):
                own = entries[ends[i] : ends[i + 1]]
                width = 1 << (BITS_PER_ENTRY * len(own) - 1).bit_length()
                width = min(max(width, LEAST_WIDTH), MOST_WIDTH)
                held = waiting.setdefault(width, [])
                held.append((block.column("id").slice(i, 1), keys[i], int(lengths[i]), own))
                if len(held) * width >= BLOCK_BITS or len(held) >= BLOCK_DOCUMENTS:
                    yield block_of(width, waiting.pop(width))
        for width, held in sorted(waiting.items()):
            yield block_of(width, held)

    return rows.mapInArrow(
        run, f"ids array<{schema_id}>, keys array<bigint>, lengths array<bigint>, width bigint, slices binary"
    )


class Items(NamedTuple):
    """Queries answered together: what tasks need to know of them."""

    terms: pa.Array  # distinct terms, binary
    counts: np.ndarray  # (items, terms), how often each item has each term


def item_blocks(items: DataFrame, text_col: str) -> Iterator[tuple[list, Items]]:
    """The distinct rows of ``items`` in blocks of bounded size, one after another."""
    held, n_terms = [], 0

    def block() -> tuple[list, Items]:
        names = sorted({t for _, own in held for t in own})
        place = {t: i for i, t in enumerate(names)}
        counts = np.zeros((len(held), len(names)), np.int64)
        for i, (_, own) in enumerate(held):
            for t, n in own.items():
                counts[i, place[t]] = n
        return [row for row, _ in held], Items(pa.array(names, pa.large_binary()), counts)

    for row in items.distinct().toLocalIterator():
        terms = find_terms(pa.array([row[text_col]], pa.string()))
        spelled = terms.distinct.to_pylist()
        own = Counter(spelled[code] for code in terms.codes.tolist())
        if not own:
            continue
        if held and (len(held) == ITEMS_PER_BLOCK or n_terms + len(own) > TERMS_PER_BLOCK):
            yield block()
            held, n_terms = [], 0
        held.append((row, own))
        n_terms += len(own)
    if held:
        yield block()


class Corpus(NamedTuple):
    n_documents: int
    n_terms: int
    weights: np.ndarray  # of the items' terms


def known_terms(terms: Terms, wanted: pa.Array) -> Terms:
    """``terms`` with those of ``wanted`` alone; codes are places in ``wanted``."""
    place = pc.fill_null(pc.index_in(terms.distinct, value_set=wanted), -1).to_numpy(zero_copy_only=False)
    codes = place[terms.codes].astype(np.int64) if len(place) else terms.codes
    before = np.concatenate([[0], np.cumsum(codes >= 0)])
    return Terms(codes[codes >= 0], before[terms.rows], wanted)


def corpus_statistics(documents: DataFrame, wanted: pa.Array, text_col: str = "text") -> Corpus:
    """Documents with a term, terms with repeats, and the weight of each wanted term,
    counted over all rows. A task returns a count per wanted term at most."""
    n_wanted = len(wanted)
    carried = documents.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        counts = np.zeros(n_wanted + 2, np.int64)
        for block in blocks(batches, text_col):
            terms = find_terms(block.column(text_col))
            counts[n_wanted] += np.count_nonzero(np.diff(terms.rows))
            counts[n_wanted + 1] += len(terms.codes)
            _, code, _ = occurrences(known_terms(terms, carried.value))
            counts[:n_wanted] += np.bincount(code, minlength=n_wanted)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["place", "n"])

    found = documents.select(text_col).mapInArrow(run, "place bigint, n bigint")
    counts = np.zeros(n_wanted + 2, np.int64)
    for place, n in found.groupBy("place").agg(F.sum("n")).collect():  # one per wanted term
        counts[place] = n
    carried.unpersist()
    n = int(counts[n_wanted])
    weights = [floor(1000 * log((2 * n + 2) / (2 * int(df) + 1))) for df in counts[:n_wanted]]
    return Corpus(n, int(counts[n_wanted + 1]), np.array(weights, np.int64))


def term_scores(tf: np.ndarray, lengths: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What an occurrence count is worth in a document of a length, before its weight."""
    m = 25 + (75 * lengths * corpus.n_documents) // corpus.n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def bounds(slices: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, weights: np.ndarray, corpus: Corpus):
    """For runs of a block's documents, their first and an upper bound of their scores
    for every item. ``slices`` is (width, bytes); ``weights`` (items, terms)."""
    width = len(slices)
    found = slices[positions(entry_hashes(hashes, 0), width)]
    held = np.bitwise_and.reduce(found, axis=1)
    met = np.flatnonzero(held.any(axis=1))
    present = np.unpackbits(held[met], axis=1, count=len(lengths), bitorder="little")
    term, document = np.nonzero(present)
    # The greatest number of occurrences that the bits allow.
    tf = lengths[document]
    open_pairs = np.arange(len(term))
    for level in range(1, len(LEVELS)):
        own = positions(entry_hashes(hashes[met], level), width)[term[open_pairs]]
        column = document[open_pairs]
        bits = (slices[own, (column >> 3)[:, None]] >> (column & 7).astype(np.uint8)[:, None]) & 1
        on = bits.all(axis=1)
        absent = open_pairs[~on]
        tf[absent] = np.minimum(tf[absent], LEVELS[level] - 1)
        open_pairs = open_pairs[on]
        if not len(open_pairs):
            break
    worth = term_scores(tf, lengths[document], corpus).astype(np.float64)
    # Whole numbers below 2**53 are exact; the factor covers items beyond that.
    own_weights = weights[:, met].astype(np.float64) * (1 + 1e-12)
    step = max(8, CELLS // max(len(met), 1))
    order = np.argsort(document, kind="stable")
    term, document, worth = term[order], document[order], worth[order]
    for first in range(0, len(lengths), step):
        a, b = np.searchsorted(document, [first, first + step])
        matrix = np.zeros((len(met), min(step, len(lengths) - first)))
        matrix[term[a:b], document[a:b] - first] = worth[a:b]
        yield first, own_weights @ matrix


def _index_blocks(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            ids, keys, lengths = (batch.column(c)[i].values for c in range(3))
            width, data = batch.column(3)[i].as_py(), batch.column(4)[i].as_buffer()
            slices = np.frombuffer(data, np.uint8).reshape(width, -1)
            yield ids, keys, lengths.to_numpy(zero_copy_only=False), slices


def _row_schema(id_type: str, *more: str) -> str:
    return ", ".join(["item bigint", f"id {id_type}", "key bigint", *more])


def best_bounds(index: DataFrame, carried, k: int, id_type: str) -> DataFrame:
    """For every item the ``k`` documents with the greatest bounds of each task."""

    def run(batches):
        hashes, weights, corpus, _ = carried.value
        best = np.full((len(weights), k), -1.0)
        who = np.full((len(weights), k), -1, np.int64)
        kept: list = []  # (ids, keys) of blocks; who says block and place
        sizes = [0]
        for ids, keys, lengths, slices in _index_blocks(batches):
            changed = False
            for first, upper in bounds(slices, lengths, hashes, weights, corpus):
                values = np.concatenate([best, np.where(upper > 0, upper, -1.0)], axis=1)
                place = np.arange(first, first + upper.shape[1]) + sizes[-1]
                names = np.concatenate([who, np.broadcast_to(place, upper.shape)], axis=1)
                top = np.argpartition(-values, k - 1, axis=1)[:, :k]
                best = np.take_along_axis(values, top, axis=1)
                new = np.take_along_axis(names, top, axis=1)
                changed = changed or bool((new != who).any())
                who = new
            kept.append((ids, keys) if changed else None)
            sizes.append(sizes[-1] + len(lengths))
        item, column = np.nonzero(best > 0)
        rows = who[item, column]
        block = np.searchsorted(sizes, rows, "right") - 1
        for b in np.unique(block):
            own = block == b
            ids, keys = kept[b]
            place = pa.array(rows[own] - sizes[b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(item[own]), ids.take(place), keys.take(place), pa.array(best[item[own], column[own]])],
                ["item", "id", "key", "bound"],
            )

    return index.mapInArrow(run, _row_schema(id_type, "bound double"))


def open_candidates(index: DataFrame, carried, id_type: str) -> DataFrame:
    """All documents whose bound for an item is above 0 and not below its floor."""

    def run(batches):
        hashes, weights, corpus, floors = carried.value
        for ids, keys, lengths, slices in _index_blocks(batches):
            for first, upper in bounds(slices, lengths, hashes, weights, corpus):
                item, column = np.nonzero((upper > 0) & (upper >= floors[:, None]))
                place = pa.array(column + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item), ids.take(place), keys.take(place)], ["item", "id", "key"]
                )

    return index.mapInArrow(run, _row_schema(id_type))


def exact_scores(rows: DataFrame, candidates: DataFrame, items: Items, corpus: Corpus, k: int) -> DataFrame:
    """(``item``, ``id``, ``score``): the ``k`` best of each task's candidates by their
    whole texts, those with a score of 0 left out.

    Few candidates are broadcast, so that only their texts leave the scan; many
    are shuffled with the texts.
    """
    per_text = materialize(candidates.groupBy("id", "key").agg(F.collect_set("item").alias("items")), "candidates")
    n_pairs = per_text.agg(F.sum(F.size("items"))).first()[0] or 0
    named = per_text.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "items")
    side = F.broadcast(named) if n_pairs <= BROADCAST_CANDIDATES else named
    met = rows.join(side, rows["id"].eqNullSafe(F.col("_id")) & (rows["key"] == F.col("_key")))
    carried = rows.sparkSession.sparkContext.broadcast((*items, corpus))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        wanted, counts, corpus = carried.value
        best: list[list[tuple]] = [[] for _ in counts]
        id_kind = None
        for block in blocks(batches, "text"):
            id_kind = block.column("id").type
            terms = find_terms(block.column("text"))
            lengths = np.diff(terms.rows)
            row, code, tf = occurrences(known_terms(terms, wanted))
            worth = term_scores(tf, lengths[row], corpus) * corpus.weights[code]
            ends = np.searchsorted(row, np.arange(block.num_rows + 1))
            ids, asked = block.column("id").to_pylist(), block.column("items")
            for i in range(block.num_rows):
                own = asked[i].values.to_numpy(zero_copy_only=False)
                part = slice(ends[i], ends[i + 1])
                scores = counts[np.ix_(own, code[part])] @ worth[part]
                for item, score in zip(own.tolist(), scores.tolist()):
                    place = (-score, ids[i] is None, ids[i])
                    held = best[item]
                    if score > 0 and (len(held) < k or place < held[-1]):
                        insort(held, place)
                        del held[k:]
        found = [(item, place[2], -place[0]) for item, held in enumerate(best) for place in held]
        if found:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], id_kind),
                    pa.array([f[2] for f in found], pa.int64()),
                ],
                ["item", "id", "score"],
            )

    return met.select("id", "text", "items").mapInArrow(run, f"item bigint, id {id_type}, score bigint")


def ranked(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item; a task has handed in ``k`` an item at most."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    documents: DataFrame,
    index: DataFrame,
    items: DataFrame,
    k: int = 10,
    item_col: str = "item_id",
    item_text: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(item, ``rank``, id, ``score``): the ``k`` best documents of each item.

    ``index`` is the stored ``build_index`` of ``documents``. Equal scores rank by
    id, a null id last; documents that score 0 do not rank. Rows that repeat an
    id and text are documents of their own, each with its rank. Null and empty
    texts have no terms: such documents count nowhere, such items get no rows. A
    row of ``items`` that repeats another's id and text counts once; an item id
    with several texts is several queries. Other columns are not read.

    Items are answered in blocks, so that what a task knows of them is bounded: a
    block costs one pass over the texts for its terms' weights, two over the
    index, and the texts of its candidates.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    item_type = items.schema[item_col].dataType.simpleString()
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    answers = []
    for asked, block in item_blocks(wanted, "text"):
        corpus = corpus_statistics(rows, block.terms)
        if not corpus.n_documents:
            break
        hashes, weights = term_hashes(block.terms), block.counts * corpus.weights
        floors = np.zeros(len(asked))

        def told():
            return spark.sparkContext.broadcast((hashes, weights, corpus, floors))

        carried = told()
        first = Window.partitionBy("item").orderBy(F.desc("bound"), "id", "key")
        probes = best_bounds(index, carried, k, id_type).withColumn("place", F.row_number().over(first))
        scored = ranked(exact_scores(rows, probes.filter(F.col("place") <= k), block, corpus, k), k)
        for item, score in scored.filter(F.col("rank") == k).select("item", "score").collect():
            floors[item] = score
        carried.unpersist()
        carried = told()
        found = ranked(exact_scores(rows, open_candidates(index, carried, id_type), block, corpus, k), k)
        found = materialize(found, "ranked")
        carried.unpersist()
        names = spark.createDataFrame([(i, row[0]) for i, row in enumerate(asked)], f"item bigint, _item {item_type}")
        answers.append(found.join(F.broadcast(names), "item"))  # ITEMS_PER_BLOCK rows
    if not answers:
        return spark.createDataFrame([], f"{item_col} {item_type}, rank int, {id_col} {id_type}, score bigint")
    whole = answers[0]
    for more in answers[1:]:
        whole = whole.unionByName(more)
    return whole.select(F.col("_item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
