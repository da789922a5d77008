"""Mixing to target weights with soft membership in domains.

A classifier fitted on a labelled table gives every document a distribution
over the domains. Nonnegative rates, one per document, are fitted by
accelerated projected-gradient least squares, so that the expected tokens of
every domain, each document's tokens shared out by its distribution and
multiplied by its rate, match the targets.

A document's rate depends on its own distribution and on the domains' errors in
all steps so far. So a step is one pass that adds up as many numbers as there
are domains, and no rate is ever stored or joined: every pass follows the steps
again for its rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from presslake.llm.sampling import Labelled, labelled_sample
from presslake.llm.words import blocks, text_bytes, tidy, word_hashes
from presslake.session import materialize

BITS = 16
PER_LABEL = 2_000
MAX_CHARS = 8_000_000
EPOCHS = 8
RATE = 0.1
PENALTY = 1e-3
TOLERANCE = 1e-4  # largest error of a domain, as a share of all target tokens
MAX_STEPS = 60
_SHAPES = 6


def _rows_of(texts: pa.Array):
    """Hashed words of each text with where its words start, and its shape figures."""
    data, offsets = text_bytes(texts)
    words, rows = word_hashes(texts, lower=False)
    sums = np.zeros((len(data) + 1, 4), np.int32)
    kinds = (
        (data >= 65) & (data <= 90), (data >= 48) & (data <= 57),
        ((data >= 33) & (data <= 47)) | ((data >= 58) & (data <= 64)) | ((data >= 91) & (data <= 96)) | ((data >= 123) & (data <= 126)),
        data <= 32,
    )
    for i, kind in enumerate(kinds):
        np.cumsum(kind, out=sums[1:, i])
    size = np.maximum(np.diff(offsets), 1)[:, None]
    shares = (sums[offsets[1:]] - sums[offsets[:-1]]) / size
    counts = np.diff(rows)
    fresh = np.array([len(np.unique(words[a:b])) for a, b in zip(rows[:-1], rows[1:])])
    shape = np.column_stack([np.sqrt(shares), fresh / np.maximum(counts, 1), np.log1p(counts) / 10])
    return (words >> np.uint64(64 - BITS)).astype(np.int64), rows, shape


class Model(NamedTuple):
    domains: list[str]
    words: np.ndarray  # hashed word, domain
    shapes: np.ndarray
    bias: np.ndarray


def _scores(words: np.ndarray, rows: np.ndarray, shape: np.ndarray, model: Model) -> np.ndarray:
    out = shape @ model.shapes + model.bias
    counts = np.diff(rows)
    filled = np.flatnonzero(counts > 0)
    if len(filled):
        sums = np.add.reduceat(model.words[words], rows[:-1][filled], axis=0)
        out[filled] += sums / np.sqrt(counts[filled])[:, None]
    return out


def _shares(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def fit(sample: list[Labelled], frequency: Mapping[str, int]) -> Model:
    """Multinomial logistic regression on hashed words and shape figures.

    The sample has as many texts of each domain as may be; ``frequency`` gives
    how often the domains are labelled, by which the distributions are weighted.
    Without labels there is no domain to fit and an error is raised.
    """
    domains = sorted(frequency)
    if not domains:
        raise ValueError("no labelled rows to fit the domains on")
    n = len(domains)
    model = Model(domains, np.zeros((1 << BITS, n), np.float64), np.zeros((_SHAPES, n)), np.zeros(n))
    labels = np.array([domains.index(row.label) for row in sample], np.int64)
    parts = [_rows_of(pa.array([row.text], pa.string())) for row in sample]
    spread = [np.full(x.shape, 1e-2) for x in model[1:]]
    rng = np.random.Generator(np.random.PCG64(3))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(sample)):
            words, rows, shape = parts[i]
            error = -_shares(_scores(words, rows, shape, model))[0]
            error[labels[i]] += 1
            own, counts = np.unique(words, return_counts=True)
            slope = counts[:, None] / max(np.sqrt(len(words)), 1.0) * error - PENALTY * model.words[own]
            for weights, squares, at, gradient in (
                (model.words, spread[0], own, slope),
                (model.shapes, spread[1], slice(None), np.outer(shape[0], error)),
                (model.bias, spread[2], slice(None), error),
            ):
                squares[at] += gradient * gradient
                weights[at] += RATE * gradient / np.sqrt(squares[at])
    drawn = np.bincount(labels, minlength=n) / max(len(sample), 1)
    true = np.array([frequency[d] for d in domains], float) / sum(frequency.values())
    return model._replace(bias=model.bias + np.log(np.maximum(true, 1e-9) / np.maximum(drawn, 1e-9)))


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    per_label: int = PER_LABEL,
    max_chars: int = MAX_CHARS,
) -> Model:
    """Fit on a bounded sample of the documents that ``labels`` names a domain for."""
    sample = labelled_sample(documents, labels, id_col, text_col, domain_col, per_label, max_chars)
    known = {row.label for row in sample}
    counts = labels.select(domain_col).dropna().groupBy(domain_col).count().collect()  # a row per domain
    return fit(sample, {row[0]: row[1] for row in counts if row[0] in known})


class Plan(NamedTuple):
    """The errors after each step, and the step sizes, from which every rate follows."""

    errors: np.ndarray  # step, domain
    momentum: np.ndarray
    size: float


def rates(shares: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """A document's rate after all steps, and the point the next step starts from."""
    rate = point = np.ones(len(shares))
    for error, momentum in zip(plan.errors, plan.momentum):
        new = np.maximum(point - plan.size * (shares @ error), 0)
        rate, point = new, np.maximum(new + momentum * (new - rate), 0)
    return rate, point


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def fit_rates(
    posteriors: DataFrame, targets: np.ndarray, tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS
) -> tuple[Plan, np.ndarray]:
    """Steps until every domain's expected tokens are within ``tolerance`` of the
    targets; returns the plan and the expected tokens. ``posteriors`` has
    ``n_tokens`` and ``shares`` and should be a stored table: each step reads it."""
    n = len(targets)
    total = max(float(targets.sum()), 1.0)

    def expected(plan: Plan, final: bool) -> np.ndarray:
        def run(batches):
            sums = np.zeros(n + 1)
            for batch in batches:
                shares = _matrix(batch.column("shares"), n)
                tokens = batch.column("n_tokens").to_numpy().astype(float)
                rate, point = rates(shares, plan)
                sums[:n] += (tokens * (rate if final else point)) @ shares
                sums[n] += tokens.sum()
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

        parts = posteriors.mapInArrow(tidy(run), "sums array<double>")
        row = parts.agg(*[F.sum(F.col("sums")[i]) for i in range(n + 1)]).first()
        return np.array([x or 0.0 for x in row])

    plan = Plan(np.empty((0, n)), np.empty(0), 0.0)
    found = expected(plan, False)
    size = total / max(found[n], 1.0)  # the step that cannot overshoot
    pace = 1.0
    while len(plan.errors) < max_steps:
        error = (found[:n] - targets) / total
        if np.abs(error).max() <= tolerance:
            break
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        plan = Plan(
            np.vstack([plan.errors, error]), np.append(plan.momentum, (pace - 1) / following), size
        )
        pace = following
        found = expected(plan, False)
    return plan, expected(plan, True)[:n]


class Mix(NamedTuple):
    model: Model
    plan: Plan
    targets: np.ndarray  # tokens per domain
    expected: np.ndarray


def plan_mix(
    documents: DataFrame,
    model: Model,
    weights: Mapping[str, float],
    text_col: str = "text",
    total_tokens: float | None = None,
    tolerance: float = TOLERANCE,
    max_steps: int = MAX_STEPS,
    keep_others: bool = False,
) -> Mix:
    """Rates by which the domains' shares of tokens become ``weights``.

    Weights are relative; a domain without one gets no tokens, or with
    ``keep_others`` the share of all tokens that it has, and the weights deal out
    the rest. The total is the documents' own by default.
    """
    unknown = set(weights) - set(model.domains)
    if unknown:
        raise ValueError(f"no label names the domains {sorted(unknown)}")
    if min(weights.values(), default=0) < 0 or not sum(weights.values()) > 0:
        raise ValueError("weights must not be negative, and one must be positive")
    stored = materialize(_with_shares(documents.select(text_col), model, text_col, None), "posteriors")
    if total_tokens is None:
        total_tokens = stored.agg(F.sum("n_tokens")).first()[0] or 0
    share = np.array([weights.get(d, 0.0) for d in model.domains])
    share = share / share.sum()
    others = [i for i, d in enumerate(model.domains) if d not in weights]
    if keep_others and others:
        sums = [F.sum(F.col("n_tokens") * F.col("shares")[i]) for i in others]
        row = stored.agg(F.sum("n_tokens"), *sums).first()
        own = np.array([(x or 0.0) / max(row[0] or 0, 1) for x in row[1:]])
        share *= max(1.0 - own.sum(), 0.0)
        share[others] = own
    targets = share * float(total_tokens)
    plan, expected = fit_rates(stored, targets, tolerance, max_steps)
    return Mix(model, plan, targets, expected)


def _with_shares(documents: DataFrame, model: Model, text_col: str, plan: Plan | None) -> DataFrame:
    kept = [] if plan is None else [c for c in documents.columns if c not in ("n_tokens", "shares", "rate")]
    added = [StructField("n_tokens", LongType()), StructField("shares", ArrayType(DoubleType()))]
    added += [] if plan is None else [StructField("rate", DoubleType())]
    carried = documents.sparkSession.sparkContext.broadcast((tuple(model), plan and tuple(plan)))

    def run(batches):
        own, steps = carried.value
        own, steps = Model(*own), steps and Plan(*steps)
        n = len(own.domains)
        for block in blocks(batches, text_col):
            words, rows, shape = _rows_of(block.column(text_col))
            shares = _shares(_scores(words, rows, shape, own))
            offsets = pa.array((np.arange(len(shares) + 1) * n).astype(np.int32))
            columns = [block.column(name) for name in kept]
            columns += [pa.array(np.diff(rows), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(shares.ravel()))]
            if steps is not None:
                columns.append(pa.array(rates(shares, steps)[0]))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *[field.name for field in added]])

    schema = StructType([documents.schema[name] for name in kept] + added)
    source = documents.select(text_col) if plan is None else documents.select(*kept)
    return source.mapInArrow(tidy(run), schema)


def mix_documents(documents: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with ``n_tokens``, ``shares`` (by domain, in name order),
    ``rate`` and ``copies``.

    Tokens are words. ``copies`` is the rate rounded up or down by a hash of id
    and text, so that its expectation is the rate; equal rows get equal results.
    A null or empty text has no tokens; its distribution is that of a text
    without words and it has a rate like any other. Input columns named like the
    results are replaced. No rows give no rows.
    """
    rated = _with_shares(documents, mix.model, text_col, mix.plan)
    chance = F.pmod(F.xxhash64(F.lit(23), id_col, text_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("bigint"))
