"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

Each text becomes the set of its character n-grams (bytes of the text with A to
Z lower-cased and white space as blanks), hashed into a table. Every n-gram's
feature value is its naive Bayes log-count ratio between toxic and clean
training texts; logistic regression is fitted on these values, and its weights
are drawn towards their mean size as in the usual NB-SVM interpolation. Where
toxic begins is set by texts that were left out of a fit: folds of the training
texts are scored by models of the others, and the scores are shifted so that
0.5 parts them best. The model is a vector of fixed size; scoring is one pass
over the table without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from presslake.llm.sampling import Labelled, labelled_sample
from presslake.llm.words import LOWER, WHITE, blocks, text_bytes, tidy

BITS = 19
ORDERS = (4, 5, 6)
PER_LABEL = 3_000
MAX_CHARS = 12_000_000
SMOOTHING = 1.0
EPOCHS = 6
PENALTY = 0.002
BLEND = 0.9
FOLDS = 3  # of the training texts, each scored by a model of the others
LEAST_VALIDATED = 60  # texts of either label below which scores are not shifted
MOST_SHIFT = 2.0  # log-odds
CLEAN_WEIGHT = 2.0  # what a clean text taken for toxic counts, against a toxic one missed
LEAST_ROWS = 4  # training texts an n-gram must be in
LEAST_DEVIATIONS = 3.5  # log-count ratio, in standard errors, below which an n-gram tells nothing

_FOLDED = np.where(WHITE, np.uint8(32), LOWER)


def ngram_rows(texts: pa.Array):
    """The hashed n-grams of each text as an array, repeats included."""
    data, offsets = text_bytes(texts)
    data = _FOLDED[data].astype(np.uint64)
    grams = np.zeros((len(data), len(ORDERS)), np.int32)
    code = np.zeros(len(data), np.uint64)
    last = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    for order in range(1, max(ORDERS) + 1):
        shift = order - 1
        n = len(data) - shift
        if n <= 0:
            break
        code[:n] |= data[shift:] << np.uint64(8 * shift)
        if order in ORDERS:
            own = ORDERS.index(order)
            hashed = ((code + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
            # Index 0 stands for "no n-gram" and has no weight.
            grams[:, own] = np.where(last >= order, np.maximum(hashed.astype(np.int32), 1), 0)
    for start, stop in zip(offsets[:-1], offsets[1:]):
        yield grams[start:stop].ravel()


class Distinct:
    """The distinct values of an index array, by one write and two reads of a table."""

    def __init__(self):
        self._seen = np.empty(1 << BITS, np.int32)
        self._order = np.arange(1 << 16, dtype=np.int32)

    def __call__(self, index: np.ndarray) -> np.ndarray:
        if len(index) > len(self._order):
            self._order = np.arange(2 * len(index), dtype=np.int32)
        order = self._order[: len(index)]
        self._seen[index] = order
        return index[self._seen[index] == order]


class Model(NamedTuple):
    weights: np.ndarray  # log-count ratio times fitted weight, per n-gram
    bias: float


def fit(sample: list[Labelled]) -> Model:
    """Fit on (text, 0 or 1); without both labels every score is their share."""
    model = _fit(sample)
    shift = _border(sample)
    return model._replace(bias=model.bias - shift)


def _border(sample: list[Labelled]) -> float:
    """The score, as log-odds, from which texts of a left-out fold are best called
    toxic: where the share of toxic texts above it exceeds ``CLEAN_WEIGHT`` times that
    of clean ones most. Of equal places within ``MOST_SHIFT`` the one nearest to even
    odds; even odds if a label is too rare."""
    labels = np.array([int(row.label) for row in sample])
    if min((labels == k).sum() for k in (0, 1)) < LEAST_VALIDATED:
        return 0.0
    # Each label's texts are dealt out in turn, in the sample's order.
    turn = np.empty(len(labels), np.int64)
    for k in (0, 1):
        turn[labels == k] = np.arange((labels == k).sum()) % FOLDS
    odds, distinct = np.empty(len(labels)), Distinct()
    for f in range(FOLDS):
        model = _fit([row for row, t in zip(sample, turn) if t != f])
        for i in np.flatnonzero(turn == f):
            p = score_texts(pa.array([sample[i].text], pa.string()), model, distinct)[0]
            odds[i] = np.log(max(p, 1e-12) / max(1 - p, 1e-12))
    order = np.argsort(odds)
    below = [np.concatenate([[0], np.cumsum(labels[order] == k)]) / (labels == k).sum() for k in (0, 1)]
    edges = np.concatenate([[odds[order[0]] - 1], odds[order], [odds[order[-1]] + 1]])
    places = np.clip(0.0, edges[:-1], edges[1:])  # the point of each gap nearest to even odds
    inner = np.clip(places, edges[:-1] + (edges[1:] - edges[:-1]) / 4, edges[1:] - (edges[1:] - edges[:-1]) / 4)
    gain = np.round(CLEAN_WEIGHT * below[0] - below[1], 9)
    gain[np.abs(inner) > MOST_SHIFT] = -np.inf
    best = np.flatnonzero(gain == gain.max())
    return float(inner[best[np.argmin(np.abs(inner[best]))]]) if np.isfinite(gain.max()) else 0.0


def _fit(sample: list[Labelled]) -> Model:
    labels = np.array([float(row.label) for row in sample])
    if not len(labels) or labels.min() == labels.max():
        share = min(max(labels.mean() if len(labels) else 0.0, 1e-3), 1 - 1e-3)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    distinct = Distinct()
    counts = np.full((2, 1 << BITS), SMOOTHING)
    for own, label in zip(_sets(sample, distinct), labels):
        counts[int(label), own] += 1
    n_rows = np.array([(labels == k).sum() for k in (0, 1)]) + 2 * SMOOTHING
    ratio = np.log(counts[1] / n_rows[1]) - np.log(counts[0] / n_rows[0])
    ratio[counts.sum(axis=0) < 2 * SMOOTHING + LEAST_ROWS] = 0
    ratio[np.abs(ratio) < LEAST_DEVIATIONS * np.sqrt((1 / counts).sum(axis=0))] = 0
    ratio[0] = 0
    ratio = ratio.astype(np.float32)
    # N-grams are found anew, so that only those that tell something are held.
    return _logistic([own[ratio[own] != 0] for own in _sets(sample, distinct)], labels, ratio)


def _sets(sample: list[Labelled], distinct: Distinct):
    """The distinct n-grams of each text, one text after another."""
    for row in sample:
        for grams in ngram_rows(pa.array([row.text], pa.string())):
            yield distinct(grams)


def _logistic(used, labels, ratio) -> Model:
    """Stochastic gradient with per-feature step sizes; rows in a fixed shuffled order."""
    weights = np.zeros(len(ratio), np.float32)
    spread = np.full(len(ratio), 1e-2, np.float32)
    bias, bias_spread = 0.0, 1e-2
    order = np.random.Generator(np.random.PCG64(5)).permutation(len(used))
    # The rarer label weighs more, though not as much as it is rarer.
    weight = np.sqrt(len(labels) / (2 * np.array([(labels == k).sum() for k in (0, 1)])))
    for _ in range(EPOCHS):
        for i in order:
            own = used[i]
            value = ratio[own]
            z = float(np.dot(weights[own], value)) + bias
            error = weight[int(labels[i])] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i])
            slope = error * value + PENALTY * weights[own]
            spread[own] += slope * slope
            weights[own] -= 0.1 * slope / np.sqrt(spread[own])
            bias_spread += error * error
            bias -= 0.1 * error / np.sqrt(bias_spread)
    fitted = weights[weights != 0]
    typical = np.abs(fitted).mean() if len(fitted) else 0.0
    blended = BLEND * weights + (1 - BLEND) * typical * (weights != 0)
    return Model((blended * ratio).astype(np.float32), bias)


def score_texts(texts: pa.Array, model: Model, distinct: Distinct) -> np.ndarray:
    sums = [float(model.weights[distinct(row)].sum(dtype=np.float64)) for row in ngram_rows(texts)]
    z = np.array(sums, np.float64) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(
    documents: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_label: int = PER_LABEL,
    max_chars: int = MAX_CHARS,
) -> Model:
    """Fit on a bounded sample of the labelled rows (``usable`` restricts them)."""
    rows = labels if usable is None else labels.filter(usable)
    return fit(labelled_sample(documents, rows, id_col, text_col, label_col, per_label, max_chars))


def score(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts have no n-grams and get the score of the bias. Columns
    of the input named like the two results are replaced. Repeated rows get
    equal scores. No shuffle: a row is scored where it is read.
    """
    kept = [name for name in documents.columns if name not in ("score", "predicted")]
    schema = StructType(
        [documents.schema[name] for name in kept]
        + [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    )
    carried = documents.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        own, distinct = Model(*carried.value), Distinct()
        for block in blocks(batches, text_col):
            scores = score_texts(block.column(text_col), own, distinct)
            columns = [block.column(name) for name in kept]
            columns += [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "predicted"])

    return documents.select(*kept).mapInArrow(tidy(run), schema)
