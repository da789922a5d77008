"""From raw documents to packed training windows, in five stages.

Every stage works on all rows its predecessor kept, and all but the last return
the columns of ``documents``. Rows that are equal in every column share their
fate in the filters; of a group of near copies exactly one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm import jaccard_join, robust_outliers, soft_mixing, toxicity
from presslake.llm.queries import packed
from presslake.llm.rows import text_key, without
from presslake.llm.sampling import fold
from presslake.session import materialize

LANGUAGE_WEIGHTS = {"en": 0.55, "de": 0.175, "fr": 0.175, "es": 0.10}


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go. It learns from the
    labelled documents outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(False))
    model = toxicity.train(docs, labels, usable=learned)
    return toxicity.score(docs, model).filter("predicted = 0").select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or lie far from their group, go."""
    rejected = robust_outliers.judge_quality(docs).filter("NOT kept")
    keys = {name: F.col(name) for name in ("doc_id", "lang", "source")}
    return without(docs, rejected, keys | {"text_key": text_key()})


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the one with the least id
    stays, a null id being the greatest; documents without words all stay."""
    linked = materialize(
        jaccard_join.link_documents(docs, size=5, threshold=0.8)
        .filter("`group` IS NOT NULL")
        .groupBy("group", "doc_id", "text_key")
        .agg(F.count("*").alias("n")),
        "linked",
    )
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = linked.groupBy("group").agg(F.min(place).alias("first"))
    judged = materialize(
        linked.join(first, "group").select("doc_id", "text_key", "n", (place == F.col("first")).alias("stays")),
        "judged",
    )
    keys = {"doc_id": F.col("doc_id"), "text_key": text_key()}
    left = without(docs, judged.filter("NOT stays"), keys)
    # Rows that repeat a document that stays, id and text alike.
    repeated = judged.filter("stays AND n > 1")
    if repeated.isEmpty():
        return left
    once = without(left, repeated, keys)
    marks = repeated.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key"))
    again = left.join(marks, same, "left_semi").withColumn("_key", text_key())
    return once.unionByName(again.dropDuplicates(["doc_id", "_key"]).drop("_key"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, so that languages have their target
    shares of all words; a language without a target keeps the share it has. The
    classifier learns from the documents' own labels."""
    labelled = docs.select("doc_id", "text", F.col("lang").alias("domain"))
    if labelled.select("doc_id", "domain").dropna().isEmpty():
        return docs
    model = soft_mixing.train(docs, labelled)
    known = {name: w for name, w in LANGUAGE_WEIGHTS.items() if name in model.domains}
    weights = known or dict.fromkeys(model.domains, 1.0)
    mixed = soft_mixing.mix_documents(docs, soft_mixing.plan_mix(docs, model, weights, keep_others=True))
    copies = mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens, a row per piece, with its ids and their CRC-32."""
    return packed(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Classifiers, iterative estimates and tokenizers are beyond SQL; the tests
# compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
