"""URL rules, sharding, outliers and licences."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from presslake.llm import license_digests, robust_outliers, url_filter, weighted_tree
from presslake.llm.queries import URL_RULES
from tests.llm.conftest import prose


def judged(spark, urls, rules=URL_RULES):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    pages = pages.withColumns({c: F.lit("x") for c in ("host", "path", "rule", "row", "id", "e", "prefix")})
    out = url_filter.judge_urls(pages, url_filter.rules_table(spark, rules)).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}


def plain_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(r.host + r.path), len(r.host), r.verdict == "block", r)
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits)[3] if fits else None
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://org", "http://ORG/", "http://a.ORG/x?y#z", "http://xorg/",
    "https://example.org/es/1", "https://www.Example.org/en/12", "https://example.org/en/2", "http://a.com/fr/",
    "http://a.com/de/x://y", "http://a.com?/de/", "http://com/de", "http://a..com/de/", "x://É.com/fr/é",
    "http://example.org/es/1", "http://example.org/es/1", "http://a.com#/fr/", "a\nb://c.com/de/\nf",
    "http://" + "a." * 200 + "com/de/" + "p" * 5000,
]


def test_urls_agree_with_a_plain_reading(spark):
    got = judged(spark, URLS)
    assert got == {i: plain_verdict(url, URL_RULES) for i, url in enumerate(URLS)}


@pytest.mark.parametrize("most", [0, 100])
def test_precedence_and_both_joins(spark, monkeypatch, most):
    rules = [
        url_filter.Rule("allow", "a.com", "/"), url_filter.Rule("block", "com", "/ab"),
        url_filter.Rule("allow", "com", "/ab"), url_filter.Rule("block", "A.com", ""),
        url_filter.Rule("block", "", "/x"), url_filter.Rule("block", "long.a.com", "/abc/def"),
    ]
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", most)
    used = [r._replace(host=r.host.lower()) for r in rules if r.host]
    urls = ["http://a.com/abc", "http://b.com/abc", "http://a.com", "http://q.long.a.com/abc/defg", "http://x/x"]
    assert judged(spark, urls, rules) == {i: plain_verdict(u, used) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert [r.verdict for r in url_filter.judge_urls(pages, none, default="block").collect()] == ["block"]
    assert url_filter.judge_urls(pages.limit(0), url_filter.rules_table(spark, URL_RULES)).collect() == []


def test_placed_documents(spark, edge_documents):
    tree = weighted_tree.plan_tree(24)
    rows = weighted_tree.place_documents(edge_documents, tree).collect()
    source = edge_documents.select("doc_id", "text").collect()
    expected = Counter(
        (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in source
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert weighted_tree.place_documents(edge_documents.limit(0), tree).collect() == []


def test_shards_follow_id_and_tree_alone_and_growth_moves_only_in(spark, monkeypatch):
    monkeypatch.setattr(weighted_tree, "ROWS_PER_BUCKET", 20)
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = weighted_tree.plan_tree(24)
    a = weighted_tree.place_documents(ids.withColumn("text", F.lit("x")), tree).collect()
    b = weighted_tree.place_documents(ids.withColumn("text", F.col("doc_id").cast("string")).repartition(7), tree)
    assert {r.doc_id: r.shard for r in a} == {r.doc_id: r.shard for r in b.collect()}
    counts = Counter(r.shard for r in a)
    assert set(counts) == set(range(24)) and max(counts.values()) < 1.25 * 20_000 / 24
    moved = [r for r in a if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {24} and 0.7 < len(moved) / (20_000 / 25) < 1.3
    for s in set(counts):
        slots = sorted(r.slot for r in a if r.shard == s)
        assert slots == list(range(len(slots)))


def test_many_equal_rows_are_written_out_in_parts(spark, monkeypatch):
    rows = spark.range(5_000).select(F.when(F.col("id") < 2_000, F.col("id")).otherwise(7).alias("doc_id"), F.lit("x").alias("text"))
    tree = weighted_tree.plan_tree(3)
    columns = ("doc_id", "shard", "slot")
    want = sorted(weighted_tree.place_documents(rows, tree).select(*columns).collect())
    monkeypatch.setattr(weighted_tree, "COPIES_PER_PART", 100)
    placed = weighted_tree.place_documents(rows, tree).select(*columns, F.spark_partition_id().alias("task"))
    got = placed.collect()
    assert sorted(tuple(r)[:3] for r in got) == [tuple(r) for r in want]
    assert "Rebalance" in placed._jdf.queryExecution().optimizedPlan().toString()


def test_shards_are_those_of_plain_draws_and_the_count_alone(spark):
    def plain(key, tree):
        nodes = {}
        for s in tree:
            u = (int(hashlib.md5(f"{key}|{s.number}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            nodes.setdefault(s.region, {}).setdefault(s.rack, []).append((-math.log(u) / s.weight, s.number))
        racks = min(nodes.values(), key=lambda racks: min(min(shards) for shards in racks.values()))
        return min(min(racks.values(), key=min))[1]

    trees = {n: weighted_tree.plan_tree(n) for n in (1, 7, 24, 25, 26)}
    weighted = [s._replace(weight=1 + s.number % 3) for s in trees[24]]
    columns = {f"s{n}": weighted_tree.shard_of(F.col("id"), tree) for n, tree in trees.items()}
    columns["w"] = weighted_tree.shard_of(F.col("id"), weighted)
    columns["added"] = weighted_tree.shard_of(F.col("id"), weighted_tree.add_shard(trees[24]))
    rows = spark.range(6_000).withColumns(columns).collect()
    for r in rows[:1_500]:
        assert all(r[f"s{n}"] == plain(r.id, tree) for n, tree in trees.items()) and r.w == plain(r.id, weighted)
    assert all(r.added == r.s25 and r.s25 in (r.s24, 24) and r.s26 in (r.s25, 25) for r in rows)
    counts, total = Counter(r.w for r in rows), sum(s.weight for s in weighted)
    assert all(0.75 < counts[s.number] / (6_000 * s.weight / total) < 1.25 for s in weighted)


def test_a_changed_weight_moves_keys_only_with_its_subtree(spark):
    tree = weighted_tree.plan_tree(16)
    heavier = [s._replace(weight=3.0) if s.number == 5 else s for s in tree]
    ids = spark.range(5_000).select(F.col("id").cast("string").alias("k"))
    rows = ids.select(
        weighted_tree.shard_of(F.col("k"), tree).alias("a"), weighted_tree.shard_of(F.col("k"), heavier).alias("b")
    ).collect()
    place = {s.number: (s.region, s.rack) for s in tree}
    for a, b in rows:
        if place[a][0] != place[b][0]:
            assert place[b][0] == place[5][0]  # into the region that grew
        elif place[a][1] != place[b][1]:
            assert place[b] == place[5]
        elif a != b:
            assert b == 5
    share = sum(b == 5 for _, b in rows) / len(rows)
    assert 2.4 / 18 < share < 3.6 / 18
    with pytest.raises(ValueError):
        weighted_tree.shard_of(F.lit("x"), [s._replace(weight=0.0) for s in tree])


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(grams)
    covered = {j for i, g in enumerate(grams) if twice[g] > 1 for j in range(i, i + 3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


TEXTS = [
    None, "", " ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "a b c d a b c e a b c", "l\nl\n\n l\nl",
    "# * <é漢😀> a\x0bb\x0cc\x85d\xa0e", "one two\r\none two\r\n", prose(5, 400), prose(5, 300) + "\n" + prose(5, 300),
    "w " * 9000, "a b a b a b c a b",
]


def test_base_statistics_agree_with_a_plain_reading(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    frame = frame.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n": F.lit(1), "x0": F.lit(2), "level": F.lit(0)})
    rows = {r.doc_id: r for r in robust_outliers.judge_quality(frame).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r, want = rows[i], plain_statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_clean_documents_stay(spark, edge_documents):
    clean = [(i, prose(i, 80 + i % 50), "en", "a" if i % 3 else "b") for i in range(600)]
    odd = [(1000 + i, " ".join(f"w{i}x{j}###" for j in range(90)), "en", "a") for i in range(40)]
    short = [(2000, "too short", "en", "a")]
    frame = spark.createDataFrame(clean + odd + short, "doc_id bigint, text string, lang string, source string")
    rows = {r.doc_id: r.kept for r in robust_outliers.judge_quality(frame).collect()}
    assert all(rows[i] for i in range(600))
    assert not any(rows[1000 + i] for i in range(40)) and not rows[2000]
    edge = robust_outliers.judge_quality(edge_documents).collect()
    assert len(edge) == edge_documents.count()
    assert robust_outliers.judge_quality(frame.limit(0)).collect() == []


@pytest.mark.parametrize("most", [0, 1000])
def test_an_outlier_alone_in_its_source_or_language_is_judged_by_the_rest(spark, monkeypatch, most):
    monkeypatch.setattr(robust_outliers, "BROADCAST_GROUPS", most)
    clean = [(i, prose(i, 80 + i % 50), "en", "a" if i % 3 else "b") for i in range(900)]
    odd = " ".join(f"w{j}###" for j in range(90))
    alone = [
        (1001, odd, "en", "only"), (1002, odd, "pt", "a"), (1003, odd, None, None),
        (1004, prose(3, 90), "en", "new"), (1005, prose(4, 90), "zh", "a"),
    ]
    frame = spark.createDataFrame(clean + alone, "doc_id bigint, text string, lang string, source string")
    rows = {r.doc_id: r for r in robust_outliers.judge_quality(frame).collect()}
    assert len(rows) == 905 and all(rows[i].kept for i in range(900))
    assert [rows[i].kept for i in range(1001, 1006)] == [False, False, False, True, True]
    assert all(rows[i].distance > 0 for i in range(1001, 1006))


@pytest.mark.parametrize("most", [0, 1000])
def test_groups_too_many_to_broadcast_judge_alike(spark, monkeypatch, most):
    monkeypatch.setattr(robust_outliers, "BROADCAST_GROUPS", most)
    monkeypatch.setattr(robust_outliers, "LEAST_GROUP", 30)
    rows = [(i, prose(i, 60 + i % 9), ["en", "fr", None][i % 3], "s" if i % 2 else None) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = robust_outliers.judge_quality(frame).collect()
    assert len(got) == 200 and all(r.kept for r in got)


def test_licences_match_whole_texts_in_any_spelling(spark, edge_documents):
    mit = license_digests.KNOWN_LICENCES["MIT"][2]
    other = "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace("SUBLICENSE", "sublicence").replace(",", " ;")
    rows = [
        (1, mit), (2, other), (3, mit + " extra"), (4, None), (5, ""), (6, "  \n"), (7, "© 1999 A\nAll rights reserved."),
        (8, mit), (8, mit), (9, "Released under the MIT Licence"), (10, "released   UNDER the mit license!"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("digest", F.lit("x"))
    known = license_digests.known_digests(spark)
    got = Counter((r.doc_id, r.licence) for r in license_digests.match_licences(frame, known).collect())
    assert got == Counter(
        {(1, "MIT"): 1, (2, "MIT"): 1, (3, None): 1, (4, None): 1, (5, None): 1, (6, None): 1, (7, None): 1,
         (8, "MIT"): 2, (9, "MIT-notice"): 1, (10, "MIT-notice"): 1}
    )
    assert license_digests.match_licences(edge_documents, known).count() == edge_documents.count()
    assert license_digests.match_licences(frame.limit(0), known).collect() == []


def test_common_licences_are_known(spark):
    names = "Apache-2.0 BSD-2-Clause BSD-3-Clause CC0-1.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MPL-2.0 Unlicense".split()
    texts = {name: license_digests.KNOWN_LICENCES[name][0] for name in names}
    bsd = "Copyright (c) 2021, Somebody\nAll rights reserved.\n\n" + texts["BSD-3-Clause"].replace("1. R", "(1) r")
    rows = [*texts.items(), ("BSD-3-Clause", bsd)]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    found = license_digests.match_licences(frame, license_digests.known_digests(spark)).collect()
    assert len(found) == len(rows) and all(r.doc_id == r.licence for r in found)


def test_many_licences_are_salted(spark, monkeypatch):
    monkeypatch.setattr(license_digests, "BROADCAST_LICENCES", 0)
    known = license_digests.known_digests(spark, {"A": ["one text"], "B": ["One Text!", "two"]})
    frame = spark.createDataFrame([(i, "ONE text") for i in range(50)] + [(99, "two")], "doc_id bigint, text string")
    got = Counter(r.licence for r in license_digests.match_licences(frame, known).collect())
    assert got == Counter({"A": 50, "B": 1})
