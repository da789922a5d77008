"""Language of words in code-switched text by a linear-chain conditional random field.

A word's features are its character bigrams and trigrams with word borders,
its affixes, and whether a lexicon learned from the labelled texts lists it for
a language. Transitions between the languages of neighbouring words are learned
too. Words are labelled by their forward-backward marginals; a document's
language is the one with the greatest marginal mass over its letters.

The model is fitted on a bounded sample and is of fixed size; labelling is one
pass over the table without a shuffle, in blocks of rows bounded by bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from presslake.llm.sampling import Labelled, labelled_sample
from presslake.llm.words import blocks, mix

UNKNOWN = "und"
BITS = 17  # feature table, per language
PER_LABEL = 150
MAX_CHARS = 2_000_000
LEXICON = 2_000  # words of a language's lexicon
LEXICON_COUNT, LEXICON_SHARE = 4, 0.9  # a listed word's least count, and share of its language
CHUNK = 64  # words of a training sequence
SPAN = 20  # mean words of one language in a mixed training sequence
BATCH = 128  # training sequences per step
EPOCHS = 4
RATE = 0.15
BLOCK_BYTES = 2 << 20
FLOOR = 1e-20  # least weight of a language for a word, the greatest being 1

_FOLD = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """The words of some texts: letters with a border before each word and one at
    the end, where each word's border is, and how many words precede each row."""

    letters: np.ndarray
    borders: np.ndarray
    rows: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(np.append(self.borders, len(self.letters) - 1)) - 1


class Letters:
    """Which code points are letters; the table grows with the greatest one met."""

    def __init__(self):
        self._table = np.zeros(0, bool)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        top = int(points.max()) + 1 if len(points) else 0
        if top > len(self._table):
            more = np.fromiter((chr(i).isalpha() for i in range(len(self._table), top)), bool)
            self._table = np.concatenate([self._table, more])
        return self._table[points]


def split_words(texts: list[str | None], is_letter: Letters) -> Words:
    """Words are runs of letters of the lower-cased texts."""
    lower = [(text or "").lower() for text in texts]
    joined = "\n".join(lower) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = is_letter(points)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    row_starts = np.cumsum([0, *(len(text) + 1 for text in lower)])
    rows = np.searchsorted(starts, row_starts)
    own = points[inside]
    before = np.cumsum(inside)[starts] - 1  # letters before each word
    borders = before + np.arange(len(starts))
    letters = np.zeros(len(own) + len(starts) + 1, np.uint64)
    mask = np.ones(len(letters), bool)
    mask[borders] = False
    mask[-1] = False
    letters[mask] = own
    return Words(letters, borders, rows)


class Features(NamedTuple):
    grams: np.ndarray  # per letter and border: a bigram and a trigram
    affixes: np.ndarray  # per word
    hashes: np.ndarray  # per word
    borders: np.ndarray


def _bucket(code: np.ndarray, kind: int) -> np.ndarray:
    hashed = ((code * np.uint64(8) + np.uint64(kind)) * _FOLD) >> np.uint64(64 - BITS)
    return np.maximum(hashed.astype(np.int32), 1)  # 0 is no feature


def features(words: Words) -> Features:
    z, borders = words.letters, words.borders
    n = len(z) - 1
    lengths = words.lengths
    pair = z[:-1] | (z[1:] << np.uint64(21))
    grams = np.zeros((n, 2), np.int32)
    grams[:, 0] = _bucket(pair, 0)
    third = np.append(z[2:], np.uint64(0))[:n]
    grams[:, 1] = np.where(z[1:] == 0, 0, _bucket(pair ^ (third << np.uint64(42)), 1))
    affixes = np.zeros((len(borders), 4), np.int32)
    ends = borders + lengths  # position of the last letter
    for column, (size, kind) in enumerate([(3, 2), (4, 3)]):
        long = lengths >= size
        for side, first in ((0, borders + 1), (2, ends - size + 1)):
            at = first[long]
            code = np.zeros(len(at), np.uint64)
            for i in range(size):
                code = code * np.uint64(0x110000 + 1) + z[at + i]
            affixes[long, side + column] = _bucket(mix(code), kind + 2 * (side > 0))
    place = np.arange(n) - np.repeat(borders, lengths + 1)
    spread = mix(z[:-1] + (place.astype(np.uint64) << np.uint64(24)))
    hashes = np.add.reduceat(spread, borders) if len(borders) else np.empty(0, np.uint64)
    return Features(grams, affixes, hashes, borders)


class Model(NamedTuple):
    langs: list[str]
    grams: np.ndarray  # feature, language
    listed: np.ndarray  # hashes of the lexicons' words, sorted
    listed_as: np.ndarray  # language number of each
    lexicon: np.ndarray  # language number (or none), language
    moves: np.ndarray  # log weight from language to language
    start: np.ndarray


def _lexicon_entry(model: Model, hashes: np.ndarray) -> np.ndarray:
    none = len(model.langs)
    if not len(model.listed):
        return np.full(len(hashes), none)
    at = np.minimum(np.searchsorted(model.listed, hashes), len(model.listed) - 1)
    return np.where(model.listed[at] == hashes, model.listed_as[at], none)


def emissions(f: Features, entry: np.ndarray, grams: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """Log weight of each language for each word."""
    if not len(f.borders):
        return np.zeros((0, grams.shape[1]), np.float32)
    per_letter = grams[f.grams[:, 0]] + grams[f.grams[:, 1]]
    scores = np.add.reduceat(per_letter, f.borders, axis=0)
    for column in range(f.affixes.shape[1]):
        scores += grams[f.affixes[:, column]]
    return scores + lexicon[entry]


def _chain(local: np.ndarray, opens: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``v[t] = (v[t-1] @ step) * local[t]`` up to a factor, anew from ``start``
    where ``opens`` holds, for all words of all rows.

    The words are cut into as many pieces as a piece has words. All pieces run
    at once from every unit vector, which tells what each makes of any vector
    that enters it; then they run once more from what does enter.
    """
    n_words, n = local.shape
    pieces = int(np.ceil(np.sqrt(n_words)))
    length = -(-n_words // pieces)
    spare = pieces * length - n_words
    weights = np.concatenate([local, np.ones((spare, n))]).reshape(pieces, length, n).transpose(1, 0, 2).copy()
    fresh = np.concatenate([opens, np.ones(spare, bool)]).reshape(pieces, length).T
    through = np.broadcast_to(np.eye(n), (pieces, n, n)).copy()
    at = [np.flatnonzero(row) for row in fresh]
    for t in range(length):
        through = (through @ step) * weights[t][:, None, :]
        if len(at[t]):
            through[at[t]] = (start * weights[t][at[t]])[:, None, :]
        if t % 8 == 7:  # eight weights of at least FLOOR do not vanish
            through /= through.max(axis=(1, 2), keepdims=True)
    now = np.empty((pieces, n))
    entering = np.full(n, 1 / n)
    for k in range(pieces):
        now[k] = entering
        entering = entering @ through[k]
        entering /= entering.sum()
    out = np.empty((length, pieces, n))
    for t in range(length):
        now = (now @ step) * weights[t]
        if len(at[t]):
            now[at[t]] = start * weights[t][at[t]]
        if t % 8 == 7:
            now /= now.sum(axis=1, keepdims=True)
        out[t] = now
    out /= (out @ np.ones(n))[:, :, None]
    return out.transpose(1, 0, 2).reshape(-1, n)[:n_words]


def marginals(scores: np.ndarray, rows: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Each word's distribution over the languages, by forward-backward."""
    if not len(scores):
        return np.zeros(scores.shape)
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + FLOOR
    step, first = np.exp(moves - moves.max()), np.exp(start - start.max())
    filled = rows[:-1][np.diff(rows) > 0]
    opens = np.zeros(len(scores), bool)
    opens[filled] = True
    closes = np.append(opens[1:], True)
    alpha = _chain(local, opens, step, first)
    # The backward pass is a chain too, from the last word to the first; its
    # vectors hold the word's own weight once more.
    beta = _chain(local[::-1], closes[::-1], step.T, np.ones(len(first)))[::-1]
    both = alpha * beta / local
    return both / both.sum(axis=1, keepdims=True)


def _training_sequences(sample: list[Labelled], langs: list[str]) -> tuple[Words, np.ndarray]:
    """Words of the sample in sequences of ``CHUNK``: every word once in its own
    text's order and once in mixed order, where spans of several texts alternate."""
    parts = split_words([row.text for row in sample], Letters())
    row_labels = np.array([langs.index(row.label) for row in sample])
    labels = np.repeat(row_labels, np.diff(parts.rows))
    rng = np.random.Generator(np.random.PCG64(11))
    spans = []
    for a, b in zip(parts.rows[:-1], parts.rows[1:]):
        at = a
        while at < b:
            to = min(b, at + 1 + int(rng.exponential(SPAN)))
            spans.append((at, to))
            at = to
    mixed = [np.arange(*spans[i]) for i in rng.permutation(len(spans))]
    order = np.concatenate([np.arange(len(labels)), *mixed])
    whole = len(order) // CHUNK * CHUNK
    return parts, np.stack([order[:whole], labels[order[:whole]]]).reshape(2, -1, CHUNK)


def _lexicons(hashes: np.ndarray, labels: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    known, word = np.unique(hashes, return_inverse=True)
    counts = np.zeros((len(known), n), np.int64)
    np.add.at(counts, (word, labels), 1)
    total = counts.sum(axis=1)
    best = counts.argmax(axis=1)
    most = counts.max(axis=1)
    listed = np.zeros(len(known), bool)
    fit_ = (most >= LEXICON_COUNT) & (most >= LEXICON_SHARE * total)
    for lang in range(n):
        own = np.flatnonzero(fit_ & (best == lang))
        listed[own[np.lexsort((known[own], -most[own]))][:LEXICON]] = True
    return known[listed], best[listed]


def fit(sample: list[Labelled]) -> Model:
    """Fit by stochastic gradient ascent on the log-likelihood of training sequences."""
    langs = sorted({row.label for row in sample})
    n = len(langs)
    empty = Model(
        langs, np.zeros((1 << BITS, n), np.float32), np.empty(0, np.uint64), np.empty(0, np.int64),
        np.zeros((n + 1, n), np.float32), np.zeros((n, n)), np.zeros(n),
    )
    if n < 2:
        return empty
    parts, (order, labels) = _training_sequences(sample, langs)
    f = features(parts)
    word_labels = np.repeat([langs.index(r.label) for r in sample], np.diff(parts.rows))
    listed, listed_as = _lexicons(f.hashes, word_labels, n)
    model = empty._replace(listed=listed, listed_as=listed_as)
    entry = _lexicon_entry(model, f.hashes)
    grams, lexicon = np.zeros((1 << BITS, n)), np.zeros((n + 1, n))
    moves, start = np.zeros((n, n)), np.zeros(n)
    spread = [np.full(x.shape, 1e-2) for x in (grams, lexicon, moves, start)]
    ends = np.append(f.borders, len(f.grams))
    rng = np.random.Generator(np.random.PCG64(12))
    for _ in range(EPOCHS):
        turns = rng.permutation(len(order))
        for at in range(0, len(turns), BATCH):
            chosen = turns[at : at + BATCH]
            _step(order[chosen], labels[chosen], f, ends, entry, (grams, lexicon, moves, start), spread)
    return model._replace(grams=grams.astype(np.float32), lexicon=lexicon.astype(np.float32), moves=moves, start=start)


def _step(words, labels, f: Features, ends, entry, weights, spread) -> None:
    grams, lexicon, moves, start = weights
    n = grams.shape[1]
    size, length = words.shape
    flat = words.ravel()
    counts = ends[flat + 1] - ends[flat]
    first = np.cumsum(counts) - counts
    at = np.repeat(ends[flat] - first, counts) + np.arange(counts.sum())
    own = Features(f.grams[at], f.affixes[flat], f.hashes[flat], first)
    scores = emissions(own, entry[flat], grams, lexicon).reshape(size, length, n)
    local = np.exp(scores - scores.max(axis=2, keepdims=True)) + FLOOR
    step = np.exp(moves)
    alpha, beta = np.empty_like(local), np.ones_like(local)
    alpha[:, 0] = local[:, 0] * np.exp(start)
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        alpha[:, t] = (alpha[:, t - 1] @ step) * local[:, t]
        alpha[:, t] /= alpha[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        beta[:, t] = (beta[:, t + 1] * local[:, t + 1]) @ step.T
        beta[:, t] /= beta[:, t].sum(axis=1, keepdims=True)
    both = alpha * beta
    both /= both.sum(axis=2, keepdims=True)
    true = np.eye(n)[labels]
    error = (true - both).reshape(-1, n)
    edges = alpha[:, :-1, :, None] * step * (beta[:, 1:] * local[:, 1:])[:, :, None, :]
    edges /= edges.sum(axis=(2, 3), keepdims=True)
    seen = np.zeros((n, n))
    np.add.at(seen, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
    per_letter = np.repeat(error, counts, axis=0)
    ids = np.concatenate([own.grams.ravel(), own.affixes.ravel()])
    values = np.concatenate([np.repeat(per_letter, 2, axis=0), np.repeat(error, own.affixes.shape[1], axis=0)])
    slope = np.stack([np.bincount(ids, values[:, k], len(grams)) for k in range(n)], axis=1)
    slope[0] = 0
    by_entry = np.zeros_like(lexicon)
    np.add.at(by_entry, entry[flat], error)
    slopes = (slope, by_entry, seen - edges.sum(axis=(0, 1)), (true[:, 0] - both[:, 0]).sum(axis=0))
    for weight, gradient, squares in zip(weights, slopes, spread):
        gradient = gradient / size
        squares += gradient * gradient
        weight += RATE * gradient / np.sqrt(squares)


def train(
    documents: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_label: int = PER_LABEL,
    max_chars: int = MAX_CHARS,
) -> Model:
    """Fit on a bounded sample of the ``usable`` rows with a language."""
    labels = documents.filter(usable).select(id_col, text_col, lang_col)
    return fit(labelled_sample(documents, labels, id_col, text_col, lang_col, per_label, max_chars))


def _labelled(texts: list[str | None], model: Model, is_letter: Letters):
    words = split_words(texts, is_letter)
    f = features(words)
    scores = emissions(f, _lexicon_entry(model, f.hashes), model.grams, model.lexicon)
    return words, marginals(scores, words.rows, model.moves, model.start)


def label_languages(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``documents`` without its text, with ``lang_pred``, ``score`` and ``spans``.

    ``spans`` lists the runs of words of one language: number of the first word
    and of the word after the last (words are runs of letters, counted from 0),
    and the language. ``score`` is the predicted language's share of the
    marginal mass. A null or empty text, or one without a letter, is ``und``
    with score 0 and no spans; so is every text if nothing was learned. Equal
    masses give the language that sorts first. Columns named like the results
    are replaced.
    """
    added = ("lang_pred", "score", "spans")
    kept = [name for name in documents.columns if name not in (text_col, *added)]
    span = StructType(
        [StructField("start", LongType()), StructField("stop", LongType()), StructField("lang", StringType())]
    )
    schema = StructType(
        [documents.schema[name] for name in kept]
        + [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
        + [StructField("spans", ArrayType(span))]
    )
    carried = documents.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        own, is_letter = Model(*carried.value), Letters()
        names = np.array([*own.langs, UNKNOWN], dtype=object)
        for block in blocks(batches, text_col, BLOCK_BYTES):
            langs, scores, spans = _predicted(block.column(text_col).to_pylist(), own, is_letter, names)
            columns = [block.column(name) for name in kept] + [langs, scores, spans]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    return documents.select(*kept, text_col).mapInArrow(run, schema)


def _predicted(texts, model: Model, is_letter: Letters, names: np.ndarray):
    n = len(model.langs)
    if n == 0:
        empty = pa.array([[] for _ in texts], pa.list_(_SPAN))
        return pa.array([UNKNOWN] * len(texts)), pa.array([0.0] * len(texts)), empty
    words, mass = _labelled(texts, model, is_letter)
    counts = np.diff(words.rows)
    weighted = np.concatenate([np.zeros((1, n)), np.cumsum(mass * words.lengths[:, None], axis=0)])
    sums = weighted[words.rows[1:]] - weighted[words.rows[:-1]]
    total = sums.sum(axis=1)
    best = sums.argmax(axis=1)
    has = counts > 0
    share = np.where(has, sums[np.arange(len(texts)), best] / np.where(has, total, 1), 0.0)
    langs = names[np.where(has, best, n)]
    word_lang = mass.argmax(axis=1)
    opens = np.ones(len(word_lang), bool)
    opens[1:] = word_lang[1:] != word_lang[:-1]
    begins = words.rows[:-1][has]
    opens[begins] = True
    at = np.flatnonzero(opens)
    stops = np.append(at[1:], len(word_lang))
    row = np.searchsorted(words.rows, at, "right") - 1
    base = words.rows[row]
    per_row = np.bincount(row, minlength=len(texts)) if len(at) else np.zeros(len(texts), int)
    flat = pa.StructArray.from_arrays(
        [pa.array(at - base, pa.int64()), pa.array(stops - base, pa.int64()), pa.array(names[word_lang[at]], pa.string())],
        ["start", "stop", "lang"],
    )
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32))
    return pa.array(langs, pa.string()), pa.array(np.clip(share, 0, 1)), pa.ListArray.from_arrays(offsets, flat)


_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])
