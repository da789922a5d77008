"""Vector pairs and the Jaccard join against comparing everything with everything."""

import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import jaccard_join, vector_pairs
from tests.llm.conftest import prose


def components(ids, links):
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return [least.get(root(i)) for i in range(len(ids))]


def vectors():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 6))
    rows = []
    for i in range(160):
        near = base[i % 12] + rng.standard_normal(6) * (0.05 if i % 3 else 0.4)
        rows.append([i, [float(np.float32(x)) for x in near], i % 2 if i % 17 else None])
    rows += [[200 + i, [1.0, 0, 0, 0, 0, 0], 0] for i in range(40)]
    rows += [[300, [2.0, 0, 0, 0, 0, 0], 0], [301, [-1.0, 0, 0, 0, 0, 0], 0], [302, [1.0, 0, 0, 0, 0, 0], 1]]
    rows += [
        [400, None, 0], [401, [], 0], [402, [0.0] * 6, 0], [403, [1.0, None, 0, 0, 0, 0], 0],
        [404, [math.nan] + [1.0] * 5, 0], [405, [math.inf] + [1.0] * 5, 0], [406, [1.0, 0, 0], 0],
        [None, [1.0, 0, 0, 0, 0, 0], 0], [200, [1.0, 0, 0, 0, 0, 0], 0],
    ]
    return [[i, v and [x if x is None else float(x) for x in v], label] for i, v, label in rows]


@pytest.mark.parametrize("block_rows", [7, 1024])
@pytest.mark.parametrize("threshold", [0.93, 0.5])
def test_vectors_agree_with_brute_force(spark, block_rows, threshold):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    frame = frame.withColumns({c: F.lit("x") for c in ("node", "bin", "block", "vector", "n_links", "kept", "id")})
    got = vector_pairs.link_vectors(frame, threshold, block_rows=block_rows).collect()
    usable = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) and label is not None
        for _, v, label in rows
    ]
    links = []
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            w, other = rows[j][1:]
            if usable[i] and usable[j] and label == other and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                    links.append((i, j))
    counts = Counter(x for pair in links for x in pair)
    least = components([r[0] for r in rows], links)
    want = Counter((r[0], counts[i], least[i], r[0] == least[i]) for i, r in enumerate(rows))
    assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("kind", ["double", "float"])
def test_labels_of_any_characters_and_extreme_components(spark, kind):
    tiny, huge = (1e-200, 1e200) if kind == "double" else (1e-40, 1e38)
    rows = [
        (1, "a/1", [1.0, 0.0]), (2, "a/2", [1.0, 0.0]), (3, "a/b", [1.0, 0.0]), (4, "a/b", [2.0, 0.01]), (5, "", [0.0, 1.0]),
        (6, "t", [tiny, 0.0]), (7, "t", [3 * tiny, 0.0]), (8, "t", [0.0, tiny]),
        (9, "h", [huge, 0.0]), (10, "h", [2 * huge, huge / 100]), (11, "h", [-huge, 0.0]), (12, "h", [5e-324, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, label string, embedding array<double>")
    frame = frame.withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_pairs.link_vectors(frame).collect()}
    near = (2, 9) if kind == "double" else (1, 9)  # the least double is no float but zero
    want = {1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8)}
    want |= {9: near, 10: near, 11: (0, 11), 12: near if kind == "double" else (0, 12)}
    assert got == want


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert vector_pairs.link_vectors(frame).collect() == []


def plain_set(text, size):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near_copies():
    rng = random.Random(2)
    rows, i = [], 0
    for base in range(25):
        words = prose(base, rng.randrange(20, 120)).split()
        for _ in range(rng.choice([1, 2, 3, 12])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10_000)}"
            rows.append((i, " ".join(copy).upper() if i % 5 == 0 else " ".join(copy)))
            i += 1
    passage = prose(77, 40)  # shared by unlike documents
    rows += [(1000 + k, passage + " " + prose(200 + k, 10 + k)) for k in range(30)]
    rows += [(2000 + k, t) for k, t in enumerate([None, "", "  \n", "a", "A", "a b", "b a", "a b c", "É b c", "é b c"])]
    return rows


@pytest.mark.parametrize(("size", "threshold"), [(3, 0.9), (5, 0.8), (1, 0.5), (3, 1.0)])
def test_documents_agree_with_brute_force(spark, size, threshold):
    rows = near_copies()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = jaccard_join.link_documents(frame, size, threshold).collect()
    sets = [plain_set(text, size) for _, text in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j]
        and len(sets[i] & sets[j]) * 100 >= round(threshold * 100) * len(sets[i] | sets[j])
    ]
    least = components([r[0] for r in rows], links)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {
        (name, len(sets[i]), least[i]) for i, (name, _) in enumerate(rows)
    }


def test_a_hot_group_of_near_copies_makes_no_pairs(spark, monkeypatch):
    """All copies link through one of them; no other candidates are left."""
    monkeypatch.setattr(jaccard_join, "FOLLOWERS", 10)
    words = prose(3, 100).split()
    rows = [(i, " ".join([*words[:50], f"x{i}", *words[51:]])) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = jaccard_join.link_documents(frame, 3, 0.9).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 120


def test_edge_documents(spark, edge_documents):
    got = jaccard_join.link_documents(edge_documents).collect()
    assert len(got) == edge_documents.count()
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert by_id == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11}
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert jaccard_join.link_documents(edge_documents.limit(0)).collect() == []


def test_prefixes_share_as_many_tokens_as_asked():
    from fractions import Fraction

    share = Fraction(9, 10)
    for n in range(1, 200):
        least = math.ceil(n * share)
        for level in range(1, 5):
            assert jaccard_join.prefix_length(n, share, level) == min(n, n - least + level)
