"""Filter interactions, and the sketch that finds texts that may repeat."""

import re
from itertools import permutations

import numpy as np
import pytest

from presslake.llm import filter_audit
from tests.llm.conftest import prose


def plain_fails(documents):
    """(part, id, the letters failed) of every row."""
    out = []
    for r in documents:
        text, part = r.text or "", r.lang or ""
        words = re.findall(r"[^\x20\x09-\x0d]+", text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": any(
                s.doc_id is not None and r.doc_id is not None and s.doc_id < r.doc_id and (s.text or "") == text
                for s in documents
            ),
        }
        out.append((part, r.doc_id, {f for f in "ABCDE" if failed[f]}))
    return out


def plain_audit(documents, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = plain_fails(documents)
    out, removals = {}, {}
    for part in {p for p, _, _ in rows}:
        own = [(i, f) for p, i, f in rows if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                lost = [(i, fs) for i, fs in left if f in fs]
                left = [(i, fs) for i, fs in left if f not in fs]
                failing = sum(f in fs for _, fs in own)
                removals[part, f] = removals.get((part, f), 0) + len(lost)
                out[part, "".join(order), step] = [
                    len(left), len(lost), failing - len(lost), sum(fs == {f} for _, fs in own),
                    sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost),
                ]
    for (part, order, step), counts in out.items():
        counts.append(removals[part, order[step - 1]])
    return out


def test_audit_agrees_with_applying_the_filters(spark, edge_documents):
    extra = [(20 + i, prose(i % 4, 250), ["en", "fr", None, ""][i % 4], "a") for i in range(12)]
    extra += [(40, "A B C # d", "en", "a"), (41, "A B C # d", "en", "a"), (None, "A B C # d", "en", "a")]
    extra += [(1, "A B C # d", "en", "a"), (42, "x " * 300, "en", "a"), (43, "x " * 300, "de", "a")]
    frame = edge_documents.unionByName(
        spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string"), allowMissingColumns=True
    )
    marks = [(1, 1, 0), (1, 0, 1), (2, 1, None), (21, 1, 1), (41, 1, 1), (43, None, 1), (None, 1, 1), (10, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    out = filter_audit.interactions(filter_audit.mask_counts(frame, labels)).collect()
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in out} == plain_audit(frame.collect(), marks)


def test_no_rows(spark, edge_documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    counts = filter_audit.mask_counts(edge_documents.limit(0), labels)
    assert filter_audit.interactions(counts).collect() == []


@pytest.mark.parametrize("width", [1 << 14, 1 << 18])
def test_sketch_never_clears_a_repeated_text(spark, width):
    hashes = np.random.default_rng(4).integers(-(2**63), 2**63, 3000)
    rows = [(int(h),) for h in hashes] + [(int(h),) for h in hashes[:500]]
    frame = spark.createDataFrame(rows, "hash bigint").repartition(7)
    suspect, _ = filter_audit.may_repeat(frame, width)
    found = {r.hash for r in frame.filter(suspect("hash")).collect()}
    assert {int(h) for h in hashes[:500]} <= found
    assert len(found) < (600 if width > 1 << 16 else 2500)


def test_merged_sketches_equal_one_over_all():
    hashes = np.random.default_rng(5).integers(-(2**63), 2**63, 999)
    whole, merged = filter_audit.Sketch(1 << 12), filter_audit.Sketch(1 << 12)
    whole.add(hashes)
    for part in np.array_split(hashes, 5):
        own = filter_audit.Sketch(1 << 12)
        own.add(part)
        merged.merge(own.once, own.twice, 0)
    assert (whole.once == merged.once).all() and (whole.twice == merged.twice).all()
    counts = np.zeros(1 << 12, int)
    for row in filter_audit.cells(hashes, 1 << 12):
        counts[np.unique(row)] += 1
    assert (np.unpackbits(whole.twice, bitorder="little") == (counts >= 2)).all()
