"""Classifiers, mixing, packing and the pipeline."""

import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from presslake.llm import langid_crf, queries, retrieval_packing, soft_mixing, toxicity
from presslake.llm.byte_bpe import Encoder
from presslake.llm.sampling import Labelled, labelled_sample, within_budget
from tests.llm.conftest import SF_DIR, prose

SF_LARGE = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_LARGE), reason="no test tables")


def encoder():
    return Encoder(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


# Languages


def test_sample_is_bounded_whole_and_independent_of_partitions(spark):
    rows = [(i, "x" * (i % 7 + 1), "ab"[i % 3 > 0]) for i in range(400)] + [(None, "x", "a"), (500, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    few = [
        labelled_sample(docs.repartition(n), docs.repartition(n).select("doc_id", "lang"), "doc_id", "text", "lang", 20, 10_000)
        for n in (1, 5)
    ]
    assert few[0] == few[1] and Counter(r.label for r in few[0]) == {"a": 20, "b": 20}
    short = labelled_sample(docs, docs.select("doc_id", "lang"), "doc_id", "text", "lang", 20, 30)
    assert sum(len(r.text) for r in short) <= 30
    assert labelled_sample(docs.limit(0), docs.limit(0).select("doc_id", "lang"), "doc_id", "text", "lang", 5, 9) == []


def test_text_and_label_are_of_one_row(spark):
    rows = [(1, "aaa english", "en"), (1, "zzz unlabelled", None), (2, "mmm", "de"), (2, "nnn", "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = labelled_sample(docs, docs, "doc_id", "text", "lang", 5, 1_000)
    assert sorted(map(tuple, got)) == [("aaa english", "en"), ("nnn", "fr")]


def test_a_binding_budget_is_shared_by_label(spark):
    rows = [(i, "x" * 100, "often" if i % 100 else "rare") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = labelled_sample(docs, docs.select("doc_id", "lang"), "doc_id", "text", "lang", 1_000, 10_000)
    assert Counter(r.label for r in got) == {"rare": 20, "often": 80}  # the rare one's unused share is passed on

    rows = [(i, "y" * 50, f"l{i % 20}" if i % 400 < 20 else "l0") for i in range(8_000)] + [(9_000, "z" * 900, "l7")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for seed in range(2):
        got = labelled_sample(docs, docs.select("doc_id", "lang"), "doc_id", "text", "lang", 500, 20 * 950, seed)
        counts = Counter(r.label for r in got if len(r.text) == 50)
        assert len(counts) == 20 and min(counts.values()) >= 18
        assert sum(len(r.text) for r in got) <= 20 * 950


def test_long_texts_come_last_in_their_labels_share():
    assert within_budget({"a": [900, *[10] * 200], "b": [40]}, 1_000) == {"a": list(range(1, 97)), "b": [0]}
    assert within_budget({"a": [500, 700]}, 1_000) == {"a": [0]}  # only long ones: as they fit
    assert within_budget({"a": [0, 2_000], "b": []}, 1_000) == {"a": [], "b": []}


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_marginals_agree_with_summing_over_all_paths(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 5, 4)
    rows = np.concatenate([[0], np.cumsum(lengths)])
    scores, moves, start = rng.normal(size=(rows[-1], 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got = langid_crf.marginals(scores, rows, moves, start)
    for a, b in zip(rows[:-1], rows[1:]):
        n = b - a
        want = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            weight = sum(scores[a + t, k] for t, k in enumerate(path))
            weight += sum(moves[i, j] for i, j in zip(path, path[1:])) + (start[path[0]] if n else 0)
            for t, k in enumerate(path):
                want[t, k] += np.exp(weight)
        if n:
            np.testing.assert_allclose(got[a:b], want / want.sum(axis=1, keepdims=True), atol=1e-9)


def test_words_are_runs_of_letters():
    words = langid_crf.split_words(["Ab1cÉ", None, "", "1 2!", "漢字 x"], langid_crf.Letters())
    assert np.diff(words.rows).tolist() == [2, 0, 0, 0, 2]
    assert words.lengths.tolist() == [2, 2, 2, 1]


def toy_model():
    rows = [Labelled(" ".join(f"{c}{'aeiou'[(i + j) % 5]}{c}n" for j in range(30)), lang) for lang, c in (("x", "b"), ("y", "k")) for i in range(8)]
    return langid_crf.fit(rows)


def test_switched_text_is_labelled_word_by_word(spark):
    text = "Bon BUN ban, bin 12 ben: kan ken kin kon"
    frame = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "1 !")], "doc_id bigint, text string")
    frame = frame.withColumns({"score": F.lit("own"), "_x": F.lit(1)})
    got = {r.doc_id: r for r in langid_crf.label_languages(frame, toy_model()).collect()}
    assert [tuple(s) for s in got[1].spans] == [(0, 5, "x"), (5, 9, "y")] and got[1].lang_pred == "x"
    assert all((got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, []) for i in (2, 3, 4))


def test_languages_without_labels_or_with_one(spark, edge_documents):
    nothing = langid_crf.label_languages(edge_documents, langid_crf.fit([])).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == edge_documents.count()
    one = {r.doc_id: r.lang_pred for r in langid_crf.label_languages(edge_documents, langid_crf.fit([Labelled("a b", "en")])).collect()}
    assert one[1] == "en" and one[4] == "und"
    assert langid_crf.label_languages(edge_documents.limit(0), toy_model()).collect() == []


@needs_tables
def test_held_out_languages(spark):
    got = queries.QUERIES["op1_langid_crf"](spark, SF_LARGE).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_LARGE}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


# Toxicity


def test_toxicity_of_edge_documents(spark, edge_documents):
    sample = [Labelled(f"{prose(i, 20)} {'nasty' if i % 2 else 'kind'}", i % 2) for i in range(60)]
    rows = toxicity.score(edge_documents, toxicity.fit(sample)).collect()
    assert len(rows) == edge_documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if not (r.text or "")}) == 1
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    found = spark.createDataFrame([(1, "a NASTY thing"), (2, "a kind thing")], "doc_id bigint, text string")
    assert [r.predicted for r in toxicity.score(found, toxicity.fit(sample)).orderBy("doc_id").collect()] == [1, 0]
    for labels in ([], [0, 0], [1]):
        model = toxicity.fit([Labelled("t", x) for x in labels])
        assert toxicity.score(edge_documents, model).count() == edge_documents.count()
    assert toxicity.score(edge_documents.limit(0), toxicity.fit(sample)).collect() == []


def test_ngrams_are_sets():
    rows = list(toxicity.ngram_rows(pa.array(["abcabcabc", None, "", "ab"])))
    distinct = toxicity.Distinct()
    got = [set(distinct(row).tolist()) - {0} for row in rows]
    want = {text[i : i + n] for text in ["abcabcabc"] for n in toxicity.ORDERS for i in range(len(text) - n + 1)}
    assert len(got[0]) == len(want) and not got[1] and not got[2] and not got[3]


@needs_tables
def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op10_toxicity"](spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    hits = sum(r.predicted == 1 and labels[r.doc_id] == 1 for r in held)
    assert hits >= 0.9 * sum(labels[r.doc_id] for r in held)
    assert hits >= 0.7 * sum(r.predicted for r in held)


# Mixing


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(5)
    shares = rng.dirichlet([0.4, 0.4, 0.4], 500)
    tokens = rng.integers(0, 300, 500)
    frame = spark.createDataFrame(
        [(int(t), [float(x) for x in s]) for t, s in zip(tokens, shares)], "n_tokens bigint, shares array<double>"
    ).repartition(3)
    for weights in ([0.5, 0.3, 0.2], [1.0, 0.0, 0.0], [0.2, 0.2, 0.6]):
        targets = np.array(weights) * tokens.sum()
        plan, expected = soft_mixing.fit_rates(frame, targets, 1e-3, 200)
        rate, _ = soft_mixing.rates(shares, plan)
        assert (rate >= 0).all()
        np.testing.assert_allclose((tokens * rate) @ shares, expected, rtol=1e-9)
        if min(weights) > 0:
            assert np.abs(expected - targets).max() <= 2e-3 * tokens.sum()


def test_mixing_edge_documents(spark, edge_documents):
    labels = spark.createDataFrame([(1, "u"), (2, "u"), (7, "v"), (10, "v"), (3, "u"), (None, "v"), (9, None)], "doc_id bigint, domain string")
    model = soft_mixing.train(edge_documents, labels)
    mix = soft_mixing.plan_mix(edge_documents, model, {"u": 1.0, "v": 3.0})
    rows = soft_mixing.mix_documents(edge_documents, mix).collect()
    assert len(rows) == edge_documents.count()
    assert all(r.rate >= 0 and r.copies >= 0 and abs(r.copies - r.rate) <= 1 for r in rows)
    assert all(abs(sum(r.shares) - 1) < 1e-9 for r in rows)
    assert all(r.n_tokens == len((r.text or "").split()) for r in rows if r.doc_id in (1, 3, 4, 7))
    assert len({(r.rate, r.copies) for r in rows if r.doc_id == 10}) == 1
    empty = edge_documents.limit(0)
    assert soft_mixing.mix_documents(empty, soft_mixing.plan_mix(empty, model, {"u": 1.0})).collect() == []
    with pytest.raises(ValueError):
        soft_mixing.plan_mix(edge_documents, model, {"w": 1.0})
    with pytest.raises(ValueError):
        soft_mixing.train(edge_documents, labels.limit(0))


@needs_tables
def test_mixed_domains_have_their_shares(spark):
    rows = queries.QUERIES["op8_soft_mixing"](spark, SF_LARGE).collect()
    shares = np.array([[r[f"share_{d}"] for d in queries.DOMAIN_WEIGHTS] for r in rows])
    tokens, rate = (np.array([r[c] for r in rows], float) for c in ("n_tokens", "rate"))
    copies = np.array([r.copies for r in rows])
    error = (tokens * rate) @ shares / tokens.sum() - np.array(list(queries.DOMAIN_WEIGHTS.values()))
    # Least squares over rates that are not negative: no rate can improve the fit.
    slope = shares @ error
    assert slope.min() > -2e-3 and np.abs(slope[rate > 1e-6]).max() < 2e-3
    assert np.abs((tokens * (copies - rate)) @ shares).max() < 0.05 * tokens.sum()


# Packing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab s'tredlvm12½\n\t\r !?.é漢😀　\x85\x1c_-", max_size=25), max_size=5))
def test_ids_are_the_tokenizers_own(texts):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = encoder_once()(texts)
    assert [g.tolist() for g in got] == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


_ENCODER = []


def encoder_once():
    if not _ENCODER:
        _ENCODER.append(encoder())
    return _ENCODER[0]


def test_special_tokens_are_read_as_the_tokenizer_does():
    text = "a <|endoftext|> b"
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder_once()([text, "a"])[0].tolist() == reference.encode(text, add_special_tokens=False).ids


def check_packed(rows, texts, window=2048, partial=1):
    """Every id in exactly one piece, sequences without gaps and full but for a few."""
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for name, text in texts:
        want[(name, tuple(reference.encode(text or "", add_special_tokens=False).ids + [1]))] += 1
    sequences, by_doc = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length and r.length > 0
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        lengths.append(at)
    assert sum(n < window for n in lengths) <= partial
    got = Counter()
    copies = Counter((name, len(ids)) for (name, ids), n in want.items() for _ in range(n))
    for (name, n), parts in by_doc.items():
        k = copies[(name, n)]
        pieces = Counter()
        for r in parts:
            for i, token in enumerate(np.frombuffer(r.ids, "<u4").tolist()):
                pieces[(r.start + i, token)] += 1
        assert sum(pieces.values()) == k * n
        if k == 1:
            got[(name, tuple(token for _, token in sorted(pieces)))] += 1
    assert got == Counter({key: n for key, n in want.items() if copies[(key[0], len(key[1]))] == 1})


def test_packed_edge_documents(spark, edge_documents):
    rows = queries.packed(edge_documents).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in edge_documents.collect()])
    assert queries.packed(edge_documents.limit(0)).collect() == []


@needs_tables
def test_packed_documents_and_small_shards(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    for size in (1 << 22, 40_000):
        rows = retrieval_packing.pack_documents(
            docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.PATTERN, shard_bytes=size,
        ).collect()
        shards = len({r.sequence_id >> 32 for r in rows})
        assert shards == 1 if size > 40_000 else shards > 5
        check_packed(rows, texts, partial=shards)


def test_rows_without_text_are_dealt_over_shards(spark):
    rows = [(i, [None, "", prose(i, 20)][i % 3]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    size = 60 * retrieval_packing.ROW_BYTES
    got = retrieval_packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN, shard_bytes=size,
    ).collect()
    check_packed(got, rows, partial=len({r.sequence_id >> 32 for r in got}))
    textless = Counter(r.sequence_id >> 32 for r in got if r.doc_tokens == 1)
    assert sum(textless.values()) == 600 and max(textless.values()) <= 90


def test_neighbours_agree_with_plain_bm25():
    texts = ["red fox runs", "red red fox", "blue sky", "fox in a blue box", "sky and sea", "red fox runs"]
    words = [t.split() for t in texts]
    df = Counter(w for some in words for w in set(some))
    table = np.zeros(1 << retrieval_packing.TERM_BITS, np.int64)
    hashes, _ = retrieval_packing.word_hashes(pa.array([" ".join(df)]))
    for w, h in zip(df, hashes):
        table[int(h) >> (64 - retrieval_packing.TERM_BITS)] += df[w]
    mean = sum(map(len, words)) / len(words)
    statistics = retrieval_packing.Statistics(table, len(texts), sum(map(len, words)), None, None)
    index = retrieval_packing.Index(pa.array(texts), statistics)
    k1, b = retrieval_packing.K1, retrieval_packing.B

    def score(query, i):
        total = 0.0
        for w in set(words[query]):
            tf = words[i].count(w)
            if tf:
                idf = np.log1p((len(texts) - df[w] + 0.5) / (df[w] + 0.5))
                total += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words[i]) / mean))
        return total

    for seed in range(len(texts)):
        scores = {i: score(seed, i) for i in range(len(texts)) if i != seed and score(seed, i) > 0}
        assert index.neighbours(seed).tolist() == sorted(scores, key=lambda i: (-round(scores[i], 9), i))


def test_blocks_of_text_give_the_ids_of_the_whole(monkeypatch):
    texts = ["", "It's a day.", prose(5, 300), "  two  blanks ", prose(6, 50), "<|endoftext|> x", ""]
    whole = [ids.tolist() for ids in encoder()(texts)]
    read = []
    block = Encoder._block
    monkeypatch.setattr(Encoder, "_block", lambda self, some: read.append(sum(map(len, some))) or block(self, some))
    monkeypatch.setattr("presslake.llm.byte_bpe.BLOCK_CHARS", 40)
    assert [ids.tolist() for ids in encoder()(texts)] == whole
    assert sum(read) == sum(map(len, texts)) and len(read) > 3
    assert encoder()([]) == []


def test_a_worker_learns_a_piece_once_for_all_its_tasks(monkeypatch):
    text = "some zyxwords for a worker"
    first = encoder()([text])[0].tolist()
    learned = []
    learn = Encoder._learn
    monkeypatch.setattr(Encoder, "_learn", lambda self, *some: learned.append(len(some[1])) or learn(self, *some))
    assert encoder()([text])[0].tolist() == first
    assert sum(learned) == 0


def test_known_pieces_are_found_by_hash():
    from presslake.llm.byte_bpe import _Pieces

    pieces, rng = _Pieces(), np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 2**64, 9_000, dtype=np.uint64) & ~np.uint64(0xFF0))  # many share a place
    rng.shuffle(hashes)
    ids = {int(h): [i, *range(i % 3)] for i, h in enumerate(hashes)}
    for some in np.array_split(hashes, 7):
        assert not pieces.find(some).any()
        own = [ids[int(h)] for h in some]
        pieces.add(some, np.array([len(x) for x in own]), np.array(sum(own, []), np.uint32))
    assert len(pieces) == len(hashes)
    flat, counts = pieces.ids(pieces.find(hashes))
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == list(ids.values())
    assert not pieces.find(hashes + np.uint64(1 << 5)).any()


def test_forgotten_pieces_are_learned_again(monkeypatch):
    texts = [prose(i, 40) for i in range(30)]
    whole = [ids.tolist() for ids in encoder()(texts)]
    monkeypatch.setattr("presslake.llm.byte_bpe.CACHED", 20)
    monkeypatch.setattr("presslake.llm.byte_bpe.BLOCK_CHARS", 100)
    assert [ids.tolist() for ids in encoder()(texts)] == whole


def test_index_blocks_give_the_terms_of_the_whole(monkeypatch):
    texts = pa.array([prose(i % 5, 30 + i) if i % 4 else None for i in range(20)], pa.string())
    words, rows = retrieval_packing.word_hashes(texts)
    row, term, count = retrieval_packing._terms(words, rows)
    monkeypatch.setattr("presslake.llm.words.blocks.__defaults__", (100,))
    got = retrieval_packing._block_terms(texts)
    assert all(np.array_equal(a, b) for a, b in zip(got, (row, term, count, rows)))


def test_all_terms_of_a_seed_are_looked_up():
    rare = [f"rare{i}" for i in range(30)]
    texts = [" ".join([*rare, "common"]), *rare, "common"]
    words = len(rare) * 2 + 2
    table = np.full(1 << retrieval_packing.TERM_BITS, 2)
    index = retrieval_packing.Index(pa.array(texts), retrieval_packing.Statistics(table, len(texts), words, None, None))
    assert sorted(index.neighbours(0).tolist()) == list(range(1, 32))


def test_windows_take_the_seeds_neighbours():
    near = {0: [3, 1], 3: [2], 2: [4]}
    pieces = retrieval_packing.pack_shard(np.array([5, 4, 3, 4, 2]), lambda s: near.get(s, []), window=8)
    assert [(p.row, p.start, p.length, p.sequence, p.offset) for p in pieces] == [
        (0, 0, 5, 0, 0), (3, 0, 3, 0, 5), (3, 3, 1, 1, 0), (2, 0, 3, 1, 1), (1, 0, 4, 1, 4), (4, 0, 2, 2, 0)
    ]


# The pipeline


@needs_tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    columns, seen = docs.columns, {}
    from presslake.session import materialize

    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF_LARGE), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["near_duplicates"]
    linked = corpus_pipeline.jaccard_join.link_documents(before, 5, 0.8).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in linked if r.doc_id == r.component_id)
    before, after = seen["quality"]
    clean = {r.doc_id for r in spark.read.parquet(f"{SF_LARGE}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    words = {r.doc_id: len(r.text.split()) for r in before.collect()}
    left = {r.doc_id for r in after.collect()}
    assert {i for i in words if i in clean and words[i] >= 60} <= left
    before, after = seen["packing"]
    rows = after.collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in before.collect())
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_a_language_without_a_target_survives_mixing(spark):
    own = {"en": "amber birch cedar", "de": "dune ember fjord", "pt": "grove heath islet", "zh": "juniper knoll larch"}
    langs = ["en"] * 4 + ["de"] * 3 + ["pt"] * 2 + ["zh"]
    rows = [(i, " ".join([own[langs[i % 10]]] * (10 + i % 7)), langs[i % 10]) for i in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    tokens = Counter()
    for r in corpus_pipeline.mixing_stage(spark, docs, "").collect():
        tokens[r.lang] += len(r.text.split())
    before = Counter()
    for _, text, lang in rows:
        before[lang] += len(text.split())
    total = sum(before.values())
    assert abs(sum(tokens.values()) / total - 1) < 0.05
    for lang in ("pt", "zh"):
        assert abs(tokens[lang] / before[lang] - 1) < 0.15
    rest = total - before["pt"] - before["zh"]
    assert abs(tokens["en"] / rest - 0.55 / 0.725) < 0.05 and abs(tokens["de"] / rest - 0.175 / 0.725) < 0.05


def test_pipeline_with_odd_rows(spark, edge_documents, tmp_path):
    columns = ["doc_id", "text", "lang", "source"]
    docs = edge_documents.select(columns)
    docs = docs.unionByName(docs.filter("doc_id = 1"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (10, 1, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    once = corpus_pipeline.near_duplicate_stage(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "")
    assert Counter(r.doc_id for r in once.collect()) == Counter([1, 3, 4, 5, 7, 9, 10, 11, None, None])
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).collect() == []


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, name):
    from tools.compare import compare, connect

    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}


def test_toxicity_border_parts_left_out_texts():
    rng = np.random.default_rng(8)
    words = [f"word{i}" for i in range(60)]
    marks = [f"vile{i}" for i in range(12)]
    sample = []
    for i in range(400):
        own = list(rng.choice(words, 20))
        if i % 4 == 0:
            own[3] = marks[i % 12]
        sample.append(Labelled(" ".join(own), int(i % 4 == 0)))
    shift = toxicity._border(sample)
    assert abs(shift) <= toxicity.MOST_SHIFT
    plain, model = toxicity._fit(sample), toxicity.fit(sample)
    assert model.bias == pytest.approx(plain.bias - shift) and (model.weights == plain.weights).all()
    assert toxicity._border(sample[:150]) == 0.0  # too few toxic ones to tell


def test_toxicity_score_is_the_sum_over_distinct_ngrams():
    sample = [Labelled(f"vile stuff {i}", 1) for i in range(30)] + [Labelled(f"fine words {i}", 0) for i in range(30)]
    model = toxicity.fit(sample)
    for text in ("Vile\tstuff and fine words, vile stuff", "", "é" * 9):
        data = bytes(32 if b in b"\t\n\x0b\x0c\r " else b + 32 * (65 <= b <= 90) for b in text.encode())
        grams = {data[i : i + n] for n in toxicity.ORDERS for i in range(len(data) - n + 1)}
        places = {
            max(((int.from_bytes(g, "little") + len(g)) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.BITS), 1) for g in grams
        }
        z = model.bias + sum(float(model.weights[p]) for p in places)
        got = toxicity.score_texts(pa.array([text]), model, toxicity.Distinct())[0]
        assert got == pytest.approx(1 / (1 + np.exp(-z)))
