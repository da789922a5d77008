"""Ranked search over bit-sliced signatures."""

import re
from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest

from presslake.llm import signature_search as search
from presslake.session import materialize
from tests.llm.conftest import prose

UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_ranks(documents, items, k=10):
    docs = [(r.doc_id, Counter(plain_terms(r.text))) for r in documents]
    docs = [(i, own, sum(own.values())) for i, own in docs if own]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, own, _ in docs for t in own)
    out = []
    for item_id, text in sorted(set(items), key=repr):
        scores = []
        for i, own, n in docs:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(
                c * floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 8 * m))
                for t, c in Counter(plain_terms(text)).items()
                if t in own
            )
            if score:
                scores.append((-score, i is None, i))
        out += [(item_id, rank, s[2], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def ranks(spark, frame, items, **options):
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    index = materialize(search.build_index(frame), "test-index")
    return sorted((tuple(r) for r in search.search(frame, index, asked, **options).collect()), key=repr)


ITEMS = [
    (1, prose(1, 30)), (2, "Amber BIRCH é 漢字 don't"), (3, ""), (4, None), (5, "!!"), (6, "nowhere"), (6, "amber0 amber0"),
    (7, prose(5, 12)), (7, prose(5, 12)), (None, "word more"), (8, "endoftext"),
]


@pytest.mark.parametrize("few", [0, 10_000])
def test_ranks_agree_with_plain_scores(spark, edge_documents, monkeypatch, few):
    monkeypatch.setattr(search, "BROADCAST_CANDIDATES", few)
    monkeypatch.setattr(search, "ITEMS_PER_BLOCK", 4)
    extra = [(50 + i, prose(i % 23, 5 + i * 3)) for i in range(60)] + [(200 + i, prose(5, 40)) for i in range(25)]
    frame = edge_documents.unionByName(
        spark.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True
    ).repartition(3)
    assert ranks(spark, frame, ITEMS) == plain_ranks(frame.collect(), ITEMS)
    assert ranks(spark, frame, ITEMS[:2], k=3) == plain_ranks(frame.collect(), ITEMS[:2], 3)


def test_narrow_signatures_are_exact_too(spark, monkeypatch):
    monkeypatch.setattr(search, "LEAST_WIDTH", 8)
    monkeypatch.setattr(search, "MOST_WIDTH", 32)
    monkeypatch.setattr(search, "CELLS", 64)
    rows = [(i, prose(i, 10 + i)) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert ranks(spark, frame, ITEMS) == plain_ranks(frame.collect(), ITEMS)


def test_nothing_to_search_or_to_ask(spark, edge_documents):
    assert ranks(spark, edge_documents.limit(0), ITEMS) == []
    assert ranks(spark, edge_documents, []) == []
    assert ranks(spark, edge_documents.filter("doc_id = 4"), ITEMS) == []


def test_bounds_hold_and_are_near():
    texts = [prose(i % 17, 20 + 7 * i) for i in range(90)] + [" ".join(["amber0"] * 50)]
    terms = search.find_terms(pa.array(texts))
    row, code, tf = search.occurrences(terms)
    lengths = np.diff(terms.rows)
    df = np.bincount(code, minlength=len(terms.distinct))
    weights = np.array([floor(1000 * log((2 * 91 + 2) / (2 * d + 1))) for d in df.tolist()])
    corpus = search.Corpus(len(texts), int(lengths.sum()), weights)
    hashes = search.term_hashes(terms.distinct)
    levels = np.searchsorted(search.LEVELS, tf, "right")
    ratios = []
    for width in (128, 1 << 14):
        bits = np.zeros((width, 96), bool)
        for r, c, n in zip(row, code, levels):
            for level in range(n):
                bits[search.positions(search.entry_hashes(hashes[c : c + 1], level), width)[0], r] = True
        slices = np.packbits(bits, axis=1, bitorder="little")
        asked = np.random.default_rng(1).integers(0, 3, (5, len(weights))) * weights
        upper = np.concatenate([u for _, u in search.bounds(slices, lengths, hashes, asked, corpus)], axis=1)
        exact = np.zeros((len(weights), len(texts)), np.int64)
        exact[code, row] = search.term_scores(tf, lengths[row], corpus)
        exact = asked @ exact
        assert (upper >= exact).all()
        ratios.append(upper.sum() / exact.sum())
    assert ratios[1] < 1.1 < ratios[0]
