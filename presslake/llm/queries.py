"""The operators as named queries over whole test tables, beside their SQL where
SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm import (
    chunk_recipes,
    filter_audit,
    jaccard_join,
    langid_crf,
    license_digests,
    oracles,
    retrieval_packing,
    robust_outliers,
    signature_search,
    soft_mixing,
    toxicity,
    url_filter,
    vector_pairs,
    weighted_tree,
)
from presslake.llm.sampling import fold
from presslake.queries.registry import Query, table
from presslake.session import materialize

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@_query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rules_table(spark, URL_RULES)
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@_query
def op3_vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_pairs.link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@_query
def op4_weighted_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_tree.place_documents(table(spark, sf_dir, "documents"), weighted_tree.plan_tree(24))


@_query
def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = robust_outliers.judge_quality(table(spark, sf_dir, "documents"))
    return judged.drop("lang", "source", "text_key", "distance")


@_query
def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = license_digests.known_digests(spark)
    return license_digests.match_licences(table(spark, sf_dir, "documents"), known)


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link_documents(table(spark, sf_dir, "documents"), size=3, threshold=0.9)
    return linked.select("doc_id", "n_shingles", "component_id")


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = toxicity.train(documents.select("doc_id", "text"), labels, usable=~held_out)
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@_query
def op1_langid_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = langid_crf.train(documents, usable=~held_out)
    labelled = langid_crf.label_languages(documents.drop("lang"), model)
    return labelled.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


DOMAIN_WEIGHTS = {"clean": 0.95, "low": 0.04, "toxic": 0.01}


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) by the labels of quality and toxicity."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
    known = labels.dropna(subset=["toxic", "quality"])
    return known.select("doc_id", domain.otherwise("clean").alias("domain"))


@_query
def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = soft_mixing.train(documents, labelled_domains(table(spark, sf_dir, "labels")))
    weights = {d: w for d, w in DOMAIN_WEIGHTS.items() if d in model.domains}
    mixed = soft_mixing.mix_documents(documents, soft_mixing.plan_mix(documents, model, weights))
    shares = [F.col("shares")[i].alias(f"share_{d}") for i, d in enumerate(model.domains)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", "copies")


def packed(documents: DataFrame) -> DataFrame:
    """Documents packed with the public byte-level vocabulary."""
    import public_tokenizers

    return retrieval_packing.pack_documents(
        documents,
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        json_path=public_tokenizers.path("byte_bpe_50k.json"),
        pattern=public_tokenizers.PATTERN,
    )


@_query
def op9_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query
def op11_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.group_exact(table(spark, sf_dir, "documents"))


@_query
def op12_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    index = materialize(signature_search.build_index(documents), "signatures")
    return signature_search.search(documents, index, table(spark, sf_dir, "benchmark"), k=10)


@_query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.interactions(counts)


ORACLES["op2_url_filter"] = oracles.URL_FILTER
ORACLES["op3_vector_pairs"] = oracles.VECTOR_PAIRS
ORACLES["op5_robust_outliers"] = oracles.robust_outliers(
    robust_outliers.SCALE, robust_outliers.LEAST_SPREAD,
    robust_outliers.INFLATION[len(robust_outliers.STATISTICS)], robust_outliers.KEPT_SHARE,
    robust_outliers.STEPS, robust_outliers.STEP_BITS, robust_outliers.LEAST_GROUP, robust_outliers.CUTOFF,
    robust_outliers.LEAST_WORDS, robust_outliers.MOST_REPEATED,
)
ORACLES["op6_license_digests"] = oracles.license_digests(
    license_digests.KNOWN_LICENCES, license_digests.EQUIVALENT_WORDS, license_digests.COPYRIGHT_LINE
)
ORACLES["op7_jaccard_join"] = oracles.JACCARD_JOIN
ORACLES["op11_chunk_recipes"] = oracles.CHUNK_RECIPES
ORACLES["op13_filter_audit"] = oracles.FILTER_AUDIT
ORACLES["op12_signature_search"] = oracles.SIGNATURE_SEARCH
