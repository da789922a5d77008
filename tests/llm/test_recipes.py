"""Exact duplicates by chunk recipes."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from presslake.llm import chunk_recipes, rows
from tests.llm.conftest import prose


def plain_groups(documents):
    """(id, keep_id, size, kept, digest) of every row, by the texts themselves."""
    groups = defaultdict(list)
    for r in documents:
        groups[r.text or ""].append(r.doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = True
        for i in ids:
            kept = stays and i == keep
            stays = stays and not kept
            out[i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def grouped(frame, **options):
    return Counter(tuple(r) for r in chunk_recipes.group_exact(frame, **options).collect())


@pytest.mark.parametrize("options", [{}, {"bits": 7}, {"bits": 3, "limit": 2}, {"least": 5, "most": 20, "bits": 12}])
def test_groups_agree_with_the_texts(spark, edge_documents, options):
    extra = [(100 + i, prose(i % 9, 900), "en", "a") for i in range(30)] + [(None, prose(1, 900), "x", "y")] * 2
    extra += [(200, prose(1, 900) + " ", "en", "a"), (201, "", "", ""), (5, " \n\t ", "fr", "b")]
    frame = edge_documents.unionByName(
        spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string"), allowMissingColumns=True
    )
    assert grouped(frame, **options) == plain_groups(frame.collect())


def test_identifiers_of_several_chunks_are_struck_off(spark):
    frame = spark.createDataFrame([(i, prose(i, 300)) for i in range(20)], "doc_id bigint, text string")
    cut = frame.select(chunk_recipes.chunks(F.col("text"), chunk_recipes.chunk_pattern(100, 200)).alias("chunks"))
    assert chunk_recipes.struck_off(cut, 2).count() == 4
    assert chunk_recipes.struck_off(cut, 64).count() == 0


def test_chunks_make_up_the_text_and_follow_its_content(spark):
    text = prose(3, 3_000)
    moved = "A few words in front, to move all that follows. " + text
    texts = spark.createDataFrame([(text,), (moved,), ("x" * 50_000,), ("漢字。" * 9_000,), ("\n" * 3_000,)], "text string")
    out = [r.c for r in texts.select(chunk_recipes.chunks(F.col("text"), chunk_recipes.chunk_pattern()).alias("c")).collect()]
    assert ["".join(c) for c in out] == [r.text for r in texts.collect()]
    assert max(len(c) for some in out for c in some) <= chunk_recipes.MOST_CHARS + 2
    assert len(set(out[0]) & set(out[1])) >= len(out[0]) - 4


def test_repeated_rows_are_written_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(rows, "COPIES_PER_PART", 3)
    monkeypatch.setattr(chunk_recipes, "COPIES_PER_PART", 3)
    frame = spark.createDataFrame([(1, "a")] * 10 + [(2, "b")], "doc_id bigint, text string")
    assert grouped(frame) == plain_groups(frame.collect())


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert chunk_recipes.group_exact(frame).collect() == []


def test_no_python_in_the_plan(spark, edge_documents):
    plan = chunk_recipes.group_exact(edge_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
