"""Titles, labels, splits, TF-IDF, classifier and report over ``documents``.

The keywords of Spanish headlines occur in none of the test tables, so the
labels here come from word parts of the tables' four languages.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from presslake.functions.text import HEADLINE_KEYWORDS, keyword_label, normalize, tokens
from presslake.operators.classifier import fit_classifier
from presslake.operators.report import (
    accuracy,
    class_scores,
    classification_report,
    report_lines,
)
from presslake.operators.split import train_test_split
from presslake.operators.tfidf import fit_tfidf, idf, term_statistics, tfidf_weights, top_terms, vocabulary
from presslake.plans.classify import evaluate, labelled_titles, preview, require_column
from presslake.queries.registry import query, table
from presslake.session import fresh_path, materialize
from presslake.sinks.tables import write_report

TABLE_KEYWORDS = (
    (1, "thing|ation|ouble"),
    (2, "eau[xt]|queen"),
    (3, "ción|mente"),
    (4, "sch|ungen"),
)
LANGUAGES = (("de", 4), ("en", 1), ("es", 3), ("fr", 2))

_NORMAL = "trim(regexp_replace(lower(coalesce({}, '')), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'))"


def _label_sql(title, rules=TABLE_KEYWORDS):
    cases = " ".join(
        f"WHEN regexp_matches({title}, '{pattern}') THEN {value}" for value, pattern in reversed(rules)
    )
    return f"CASE {cases} ELSE 0 END"


_LABELLED = f"""
SELECT doc_id, lang, title, {_label_sql("title")} AS label
FROM (SELECT doc_id, lang, {_NORMAL.format("text")} AS title FROM documents) WHERE length(title) > 0
"""


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _labelled(spark, sf_dir):
    documents = _documents(spark, sf_dir).select("doc_id", "lang", "text")
    return labelled_titles(documents, "text", TABLE_KEYWORDS)


@query(f"""
SELECT doc_id, md5({_NORMAL.format("text")}) AS digest,
       CAST(length({_NORMAL.format("text")}) AS INTEGER) AS length
FROM documents
""")
def normalize_title(spark, sf_dir):
    normal = _documents(spark, sf_dir).select("doc_id", normalize(F.col("text")).alias("title"))
    return normal.select("doc_id", F.md5("title").alias("digest"), F.length("title").alias("length"))


@query(f"SELECT doc_id, CAST(label AS INTEGER) AS label FROM ({_LABELLED})")
def keyword_labels(spark, sf_dir):
    return _labelled(spark, sf_dir).select("doc_id", "label")


@query(f"""
SELECT CAST({_label_sql("title", HEADLINE_KEYWORDS)} AS INTEGER) AS label, count(*) AS n
FROM (SELECT {_NORMAL.format("text")} AS title FROM conversations) WHERE length(title) > 0 GROUP BY 1
""")
def headline_label_counts(spark, sf_dir):
    """The headline keywords themselves, over the conversations."""
    titles = labelled_titles(table(spark, sf_dir, "conversations").select("text"), "text")
    return titles.groupBy("label").agg(F.count("*").alias("n"))


@query(f"SELECT CAST(label AS INTEGER) AS label, count(*) AS n FROM ({_LABELLED}) GROUP BY 1")
def label_counts(spark, sf_dir):
    return _labelled(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS n_rows, count(DISTINCT label) AS n_classes FROM ({_LABELLED})")
def row_and_class_count(spark, sf_dir):
    return _labelled(spark, sf_dir).agg(
        F.count("*").alias("n_rows"), F.count_distinct("label").alias("n_classes")
    )


@query("SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def preview_rows(spark, sf_dir):
    documents = _documents(spark, sf_dir).select("doc_id", "lang", "source", "n_chars")
    return preview(documents.orderBy("doc_id"))


_SPLIT = """
WITH counts AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
sizes AS (SELECT sum(n) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_test FROM counts),
floors AS (
  SELECT lang, n, n * (total - n_test) // total AS floor, (n * (total - n_test)) % total AS remainder,
         total - n_test AS n_train
  FROM counts, sizes),
quotas AS (
  SELECT lang, n - floor - CASE WHEN row_number() OVER (ORDER BY remainder DESC, lang)
         <= n_train - sum(floor) OVER () THEN 1 ELSE 0 END AS take
  FROM floors),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) AS rank
  FROM documents),
parts AS (
  SELECT ranked.*, CASE WHEN rank <= take THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN quotas USING (lang))
"""


def _split(spark, sf_dir, *columns):
    return train_test_split(_documents(spark, sf_dir).select("doc_id", "lang", *columns), "doc_id", "lang")


@query(_SPLIT + "SELECT lang, split, count(*) AS n FROM parts GROUP BY ALL")
def split_counts(spark, sf_dir):
    return _split(spark, sf_dir).groupBy("lang", "split").agg(F.count("*").alias("n"))


@query(_SPLIT + "SELECT doc_id, lang, split FROM parts")
def split_rows(spark, sf_dir):
    return _split(spark, sf_dir)


@query("""
WITH ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS rank,
         ceil(0.2 * count(*) OVER ()) AS n_test
  FROM documents)
SELECT doc_id, CASE WHEN rank <= n_test THEN 'test' ELSE 'train' END AS split FROM ranked
""")
def split_unstratified(spark, sf_dir):
    documents = _documents(spark, sf_dir).select("doc_id", "lang")
    rows = train_test_split(documents, "doc_id", "lang", seed=7, stratify=False)
    return rows.select("doc_id", "split")


_TOKENS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')"


@query(f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {_TOKENS} AS t FROM documents)
""")
def token_lists(spark, sf_dir):
    lists = _documents(spark, sf_dir).select("doc_id", tokens(F.col("text")).alias("t"))
    return lists.select(
        "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest")
    )


def _terms_sql(where="TRUE"):
    return f"""
      tokens AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents WHERE {where}),
      terms AS (SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM tokens GROUP BY term),
      vocab AS (SELECT * FROM terms ORDER BY n DESC, term LIMIT 5000),
      idf AS (SELECT *, ln((1.0 + (SELECT count(*) FROM documents WHERE {where})) / (1 + df)) + 1 AS idf
              FROM vocab)"""


def _weights_sql(where):
    return f"""
      counted AS (SELECT doc_id, term, count(*) AS c
                  FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents WHERE {where})
                  GROUP BY ALL),
      weighted AS (SELECT doc_id, term, c * idf AS w FROM counted JOIN idf USING (term)),
      scaled AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
                 FROM weighted)"""


@query(f"WITH {_terms_sql()} SELECT term, n, df FROM vocab")
def vocab_topk(spark, sf_dir):
    return top_terms(_documents(spark, sf_dir), "text")


@query(f"WITH {_terms_sql()} SELECT term, n, df FROM terms ORDER BY n DESC, term LIMIT 100")
def vocab_small_summaries(spark, sf_dir):
    """The 100 most frequent terms from summaries far smaller than the vocabulary."""
    return top_terms(_documents(spark, sf_dir), "text", 100, summary_terms=400)


@query(f"WITH {_terms_sql()} SELECT term, n, df FROM vocab")
def vocab_all_terms(spark, sf_dir):
    """The vocabulary by the way that shuffles every term."""
    return vocabulary(term_statistics(_documents(spark, sf_dir), "text"))


@query(f"WITH {_terms_sql()} SELECT term, n, df, round(idf, 6) AS idf FROM idf")
def idf_weights(spark, sf_dir):
    weights = idf(_documents(spark, sf_dir), "text")
    return weights.select("term", "n", "df", F.round("idf", 6).alias("idf"))


@query(f"""
WITH {_terms_sql()}, {_weights_sql("TRUE")}
SELECT doc_id, term, round(weight, 6) AS weight FROM documents LEFT JOIN scaled USING (doc_id)
""")
def tfidf_document_weights(spark, sf_dir):
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    rows = tfidf_weights(documents, fit_tfidf(documents, "text"), "doc_id", "text")
    return rows.withColumn("weight", F.round("weight", 6))


@query(f"""
WITH {_terms_sql("lang = 'en'")}, {_weights_sql("lang <> 'en'")}
SELECT doc_id, term, round(weight, 6) AS weight
FROM (SELECT doc_id FROM documents WHERE lang <> 'en') LEFT JOIN scaled USING (doc_id)
""")
def tfidf_heldout_weights(spark, sf_dir):
    """Documents of other languages by the vocabulary of the English ones."""
    documents = _documents(spark, sf_dir).select("doc_id", "lang", "text")
    model = fit_tfidf(documents.filter("lang = 'en'"), "text")
    rows = tfidf_weights(documents.filter("lang <> 'en'"), model, "doc_id", "text")
    return rows.withColumn("weight", F.round("weight", 6))


def _language_classes(documents):
    label = F.element_at(
        F.create_map(*[F.lit(item) for pair in LANGUAGES for item in pair]), F.col("lang")
    )
    return documents.withColumn("label", label)


_TRUTH = " ".join(f"WHEN '{lang}' THEN {label}" for lang, label in LANGUAGES)


@query(_SPLIT + f"""
SELECT 'prediction' AS what, doc_id AS id, CAST(CASE lang {_TRUTH} END AS BIGINT) AS label, TRUE AS holds
FROM parts WHERE split = 'test'
UNION ALL SELECT DISTINCT 'slope', CAST(NULL AS BIGINT), CAST(CASE lang {_TRUTH} END AS BIGINT), TRUE FROM parts
""")
def regression_conditions(spark, sf_dir):
    """What makes a fit right: for every class the loss has no slope left at the
    fitted weights, a thousandth of a document per document at most, and every
    test document's class is the one with the greatest score by the weights."""
    documents = _language_classes(_documents(spark, sf_dir)).select("doc_id", "lang", "text", "label")
    rows = materialize(train_test_split(documents, "doc_id", "lang"), "regression_rows")
    train = rows.filter("split = 'train'")
    classifier = fit_classifier(train, "text", "label")
    model, classes = classifier.model, classifier.classes
    weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    scored = _scores(classifier, rows, weights, intercepts).join(rows.select("doc_id", "split"), "doc_id")
    scored = materialize(scored, "scores")
    best = scored.groupBy("doc_id").agg(F.max(F.struct("score", "class")["score"]).alias("top"))
    predicted = classifier.predict(rows.filter("split = 'test'"), "text").select("doc_id", "label", "prediction")
    own = scored.select("doc_id", F.col("class").alias("prediction"), "score")
    holds = F.col("score") >= F.col("top") - 1e-6
    tests = predicted.join(own, ["doc_id", "prediction"]).join(best, "doc_id").select(
        F.lit("prediction").alias("what"), F.col("doc_id").alias("id"), F.col("label").cast("bigint"), holds.alias("holds")
    )
    return tests.unionByName(_slopes(classifier, train, scored, weights, classes))


def _scores(classifier, rows, weights, intercepts):
    """(doc_id, class, score, label) from the features by sums of products."""
    terms = _feature_rows(classifier, rows)
    parts = [
        F.sum(F.col("value") * F.element_at(F.array(*[F.lit(float(w)) for w in line]), F.col("index") + 1))
        for line in weights
    ]
    summed = terms.groupBy("doc_id").agg(*[part.alias(f"s{k}") for k, part in enumerate(parts)])
    filled = rows.select("doc_id", "label").join(summed, "doc_id", "left")
    scores = F.array(*[
        F.struct(F.lit(c).alias("class"), (F.coalesce(f"s{k}", F.lit(0.0)) + float(intercepts[k])).alias("score"))
        for k, c in enumerate(classifier.classes)
    ])
    each = filled.select("doc_id", "label", F.explode(scores).alias("e"))
    return each.select("doc_id", "label", "e.class", "e.score")


def _feature_rows(classifier, rows):
    vectors = classifier.features.transform(rows.select("doc_id", "text"), "text", "_features")
    dense = vectors.select("doc_id", F.posexplode(vector_to_array("_features")).alias("index", "value"))
    return dense.filter("value <> 0")


def _slopes(classifier, train, scored, weights, classes):
    own = scored.filter("split = 'train'")
    total = own.groupBy("doc_id").agg(F.sum(F.exp("score")).alias("total"))
    error = own.join(total, "doc_id").select(
        "doc_id", "class", (F.exp("score") / F.col("total") - (F.col("class") == F.col("label")).cast("double")).alias("error")
    )
    by_term = _feature_rows(classifier, train).join(error, "doc_id").groupBy("class", "index").agg(
        F.sum(F.col("error") * F.col("value")).alias("slope")
    )
    places = F.create_map(*[x for k, c in enumerate(classes) for x in (F.lit(c), F.array(*[F.lit(float(w)) for w in weights[k]]))])
    slope = F.col("slope") + F.element_at(F.element_at(places, F.col("class")), F.col("index") + 1)
    worst = by_term.select("class", F.abs(slope).alias("slope")).unionByName(
        error.groupBy("class").agg(F.abs(F.sum("error")).alias("slope"))
    )
    n = train.count()
    return worst.groupBy("class").agg((F.max("slope") <= 1e-3 * n).alias("holds")).select(
        F.lit("slope").alias("what"), F.lit(None).cast("bigint").alias("id"), F.col("class").cast("bigint").alias("label"), "holds"
    )


# Titles of the headline keywords' language, with the label each must have.
SPANISH_TITLES = (
    ("El GOL del equipo {id}", 1), ("Fútbol y política {id}", 2), ("La salud {id}", 3), ("¡Cine y música! {id}", 4),
    ("una parte {id}", 4), ("golpear {id}", 1), ("futbol {id}", 0), ("Gobierno: congreso de medicina {id}", 3),
    ("nada {id}", 0), ("ELECCIONES_{id}", 2), ("¿?", None),
)


@query(
    "SELECT doc_id, label FROM documents JOIN (VALUES "
    + ", ".join(f"({i}, {label})" for i, (_, label) in enumerate(SPANISH_TITLES) if label is not None)
    + f") AS t(form, label) ON doc_id % {len(SPANISH_TITLES)} = form"
)
def spanish_keyword_labels(spark, sf_dir):
    """The shipped keywords on titles that hold them, one for each document."""
    form = F.element_at(F.array(*[F.lit(t) for t, _ in SPANISH_TITLES]), (F.col("doc_id") % len(SPANISH_TITLES) + 1).cast("int"))
    title = F.replace(form, F.lit("{id}"), F.col("doc_id").cast("string"))
    return labelled_titles(_documents(spark, sf_dir).select("doc_id", title.alias("title"))).select("doc_id", "label")


@query("""
SELECT 'text' AS column, 'found' AS outcome, count(*) AS n FROM documents
UNION ALL SELECT 'titular', 'missing', count(*) FROM documents
UNION ALL SELECT 'no titles', 'no report', 0
""")
def classifier_checks(spark, sf_dir):
    """The column check on the documents' columns, and the stop without titles."""
    documents = _documents(spark, sf_dir)
    rows = []
    for name in ("text", "titular"):
        try:
            rows.append(require_column(documents, name).select(F.lit(name), F.lit("found")))
        except ValueError:
            rows.append(documents.select(F.lit(name), F.lit("missing")))
    found = rows[0].union(rows[1]).toDF("column", "outcome").groupBy("column", "outcome").agg(F.count("*").alias("n"))
    none = labelled_titles(documents.select("doc_id", F.lit("¿?").alias("title")))
    outcome = "no report" if evaluate(none, "doc_id") is None else "report"
    return found.unionByName(none.agg(F.count("*").alias("n")).select(
        F.lit("no titles").alias("column"), F.lit(outcome).alias("outcome"), "n"
    ))


@query()
def train_predict(spark, sf_dir):
    """Languages of the test documents as predicted; checked by the tests."""
    documents = _language_classes(_documents(spark, sf_dir)).select("doc_id", "text", "label")
    return evaluate(documents, "doc_id", "text").predictions.select("doc_id", "label", "prediction")


@query()
def classification_text(spark, sf_dir):
    """The whole way from texts to the lines of the classification report."""
    titles = _labelled(spark, sf_dir).select("doc_id", "title", "label")
    return report_lines(evaluate(materialize(titles, "titles"), "doc_id").report)


def _predicted(spark, sf_dir):
    """Keyword labels as truth and a class by language and source as prediction,
    so that some class is only ever predicted and another never."""
    prediction = F.when(F.col("lang") == "en", 1).when(F.col("lang") == "fr", 2).otherwise(7)
    titles = _documents(spark, sf_dir).select("lang", normalize(F.col("text")).alias("title"))
    return titles.select(
        keyword_label(F.col("title"), TABLE_KEYWORDS).alias("label"), prediction.alias("prediction")
    )


_PREDICTED = f"""
predicted AS (SELECT CAST({_label_sql("title")} AS INTEGER) AS label,
                     CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 7 END AS prediction
              FROM (SELECT lang, {_NORMAL.format("text")} AS title FROM documents)),
classes AS (SELECT label AS class FROM predicted UNION SELECT prediction FROM predicted),
counts AS (SELECT class, (SELECT count(*) FROM predicted WHERE label = class) AS support,
                  (SELECT count(*) FROM predicted WHERE prediction = class) AS guessed,
                  (SELECT count(*) FROM predicted WHERE label = class AND prediction = class) AS hits
           FROM classes),
scores AS (SELECT class, CASE WHEN guessed = 0 THEN 0.0 ELSE hits::DOUBLE / guessed END AS precision,
                  CASE WHEN support = 0 THEN 0.0 ELSE hits::DOUBLE / support END AS recall,
                  2.0::DOUBLE * hits / (support + guessed) AS f1, support, hits
           FROM counts),
report AS (
  SELECT 0 AS section, class, CAST(class AS VARCHAR) AS name, precision, recall, f1, support FROM scores
  UNION ALL SELECT 1, NULL, 'accuracy', NULL, NULL, sum(hits)::DOUBLE / sum(support), sum(support)::BIGINT
  FROM scores
  UNION ALL SELECT 2, NULL, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT
  FROM scores
  UNION ALL SELECT 3, NULL, 'weighted avg', sum(precision * support) / sum(support),
                   sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                   sum(support)::BIGINT FROM scores)
"""


@query(f"""
WITH {_PREDICTED} SELECT CAST(class AS INTEGER) AS class, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM scores
""")
def class_report(spark, sf_dir):
    scores = class_scores(_predicted(spark, sf_dir))
    return scores.select(
        "class", *[F.round(name, 9).alias(name) for name in ("precision", "recall", "f1")], "support"
    )


@query(f"""
WITH {_PREDICTED} SELECT name, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM report
""")
def report_averages(spark, sf_dir):
    report = classification_report(_predicted(spark, sf_dir))
    return report.select(
        "name", *[F.round(name, 9).alias(name) for name in ("precision", "recall", "f1")], "support"
    )


@query("""
SELECT round(avg(CASE WHEN l.quality = p.guess THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS accuracy
FROM labels l JOIN (SELECT doc_id, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS guess FROM documents) p
USING (doc_id)
""")
def accuracy_score(spark, sf_dir):
    """Quality labels against a guess by length."""
    guess = F.when(F.col("n_chars") > 500, 1).otherwise(0)
    guesses = _documents(spark, sf_dir).select("doc_id", guess.alias("prediction"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return accuracy(labels.join(guesses, "doc_id")).select(F.round("accuracy", 9).alias("accuracy"))


def _line_sql():
    def cell(column):
        return f"' ' || lpad(coalesce(printf('%.2f', {column}), ''), 9, ' ')"

    row = (
        f"lpad(name, 12, ' ') || ' ' || {cell('precision')} || {cell('recall')} || {cell('f1')}"
        " || ' ' || lpad(CAST(support AS VARCHAR), 9, ' ')"
    )
    return f"""
      lines AS (
        SELECT 0 AS part, 0 AS class, 'Model Accuracy: ' || CAST(f1 AS VARCHAR) AS line
        FROM report WHERE section = 1
        UNION ALL SELECT 1, 0, 'Classification Report:'
        UNION ALL SELECT 2, 0, '              precision    recall  f1-score   support'
        UNION ALL SELECT 3, 0, ''
        UNION ALL SELECT 4, class, {row} FROM report WHERE section = 0
        UNION ALL SELECT 5, 0, ''
        UNION ALL SELECT 5 + section, 0, {row} FROM report WHERE section > 0)"""


@query(f"""
WITH {_PREDICTED}, {_line_sql()}
SELECT CAST(row_number() OVER (ORDER BY part, class) AS INTEGER) AS line_no, line FROM lines
""")
def report_text(spark, sf_dir):
    return report_lines(classification_report(_predicted(spark, sf_dir)))


@query(f"WITH {_PREDICTED}, {_line_sql()} SELECT line FROM lines")
def report_file(spark, sf_dir):
    """The report as it stands in its file."""
    lines = report_lines(classification_report(_predicted(spark, sf_dir)))
    return spark.read.text(write_report(lines, fresh_path(spark, "reports"), "test")).withColumnRenamed("value", "line")
