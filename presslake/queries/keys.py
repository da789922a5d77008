"""Keys, landing messages and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions import keys as K
from presslake.functions.outcomes import FETCHED, HTTP_ERROR, OTHER_ERROR
from presslake.operators.collisions import last_writers
from presslake.operators.landing import fetch_outcomes, outcome_summary
from presslake.queries.extraction import AS_OF, domain
from presslake.queries.registry import query, table
from presslake.sources.pages import BAD_EVENT, event_objects, page_events, pages_of_events


def _order_keys(spark, sf_dir):
    """Well-formed and odd keys, by order priority."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status, number = F.col("o_orderstatus"), F.col("o_orderkey")
    key = (
        F.when(F.col("o_orderpriority") == "1-URGENT",
               F.format_string("headlines/raw/%s/%s/%s_%s.html", status, day, status, day))
        .when(F.col("o_orderpriority") == "2-HIGH", F.format_string("headlines/raw/%s_%d.html", status, number))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.format_string("headlines/raw/%s/%sx/a.html", status, day))
        .when(F.col("o_orderpriority") == "5-LOW", F.format_string("%s.html", status))
        .otherwise(F.format_string("headlines/raw/%s/%s-1/b.html", status, day))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("key"))


_ORDER_KEYS = """
SELECT o_orderkey,
  CASE o_orderpriority
    WHEN '1-URGENT' THEN 'headlines/raw/' || o_orderstatus || '/' || d || '/' || o_orderstatus || '_' || d || '.html'
    WHEN '2-HIGH' THEN 'headlines/raw/' || o_orderstatus || '_' || o_orderkey || '.html'
    WHEN '3-MEDIUM' THEN 'headlines/raw/' || o_orderstatus || '/' || d || 'x/a.html'
    WHEN '5-LOW' THEN o_orderstatus || '.html'
    ELSE 'headlines/raw/' || o_orderstatus || '/' || d || '-1/b.html' END AS key
FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
"""
_PARTS = f"SELECT *, string_split(key, '/') AS parts FROM ({_ORDER_KEYS})"
_SEGMENT = "CASE WHEN len(parts) > 1 THEN parts[len(parts) - 1] END"
_DATED = "coalesce(regexp_matches(segment, '^[0-9]{4}-[0-9]{2}-[0-9]{2}'), false)"
_PLACED = f"""
SELECT *, {_DATED} AS dated, string_split(CASE WHEN {_DATED} THEN segment ELSE '2025-05-26' END, '-') AS ymd,
       CASE WHEN {_DATED} THEN segment ELSE '2025-05-26' END AS file_date,
       CASE WHEN len(parts) > 2 THEN parts[3] ELSE 'unknown' END AS source
FROM (SELECT *, {_SEGMENT} AS segment FROM ({_PARTS}))
"""


@query(f"SELECT o_orderkey, source, segment, dated FROM ({_PLACED})")
def key_parse(spark, sf_dir):
    key = F.col("key")
    segment = K.date_segment(key)
    return _order_keys(spark, sf_dir).select(
        "o_orderkey",
        K.source_of(key).alias("source"),
        segment.alias("segment"),
        K.is_dated(segment).alias("dated"),
    )


@query(f"""
SELECT o_orderkey, source AS periodico, ymd[1] AS year, ymd[2] AS month, ymd[3] AS day,
       CASE WHEN segment IS NULL THEN 'key has no folder'
            WHEN len(ymd) <> 3 THEN 'date folder has more than three parts' END AS error
FROM ({_PLACED})
""")
def key_partition(spark, sf_dir):
    key = F.col("key")
    fields = K.partition_fields(key, AS_OF)
    return _order_keys(spark, sf_dir).select(
        "o_orderkey",
        *[value.alias(name) for name, value in fields.items()],
        K.key_error(key).alias("error"),
    )


@query(f"""
SELECT o_orderkey, 'headlines/final/periodico=' || source || '/year=' || ymd[1] || '/month=' || ymd[2]
       || '/day=' || ymd[3] || '/' || source || '_' || file_date || '.csv' AS final_key
FROM ({_PLACED})
""")
def final_key(spark, sf_dir):
    return _order_keys(spark, sf_dir).select(
        "o_orderkey", K.final_key(F.col("key"), AS_OF).alias("final_key")
    )


@query(f"""
SELECT o_orderkey, replace(replace(key, 'headlines/raw/', 'headlines/processed/'), '.html', '.csv')
       AS processed_key
FROM ({_ORDER_KEYS})
""")
def processed_key(spark, sf_dir):
    return _order_keys(spark, sf_dir).select(
        "o_orderkey", K.processed_key(F.col("key")).alias("processed_key")
    )


def _document_keys(spark, sf_dir):
    """Keys of documents; their language decides folder and suffix."""
    folder = F.when(F.col("lang") == "de", "headlines/final/").otherwise("headlines/raw/")
    suffix = F.when(F.col("lang") == "fr", ".txt").otherwise(".html")
    key = F.concat(folder, "source", F.lit("/"), F.col("doc_id").cast("string"), suffix)
    return table(spark, sf_dir, "documents").select("doc_id", key.alias("key"))


_DOCUMENT_KEYS = """
SELECT doc_id, CASE lang WHEN 'de' THEN 'headlines/final/' ELSE 'headlines/raw/' END || source || '/'
       || doc_id || CASE lang WHEN 'fr' THEN '.txt' ELSE '.html' END AS key
FROM documents
"""


@query(f"""
SELECT doc_id, key FROM ({_DOCUMENT_KEYS})
WHERE starts_with(key, 'headlines/raw/') AND ends_with(key, '.html')
""")
def key_filter(spark, sf_dir):
    return _document_keys(spark, sf_dir).filter(K.is_page_key(F.col("key")))


@query("""
SELECT doc_id, md5(text) AS decoded,
       md5(url_decode(replace(replace(replace(
         regexp_replace(text, '%([0-9A-Fa-f]{2})', chr(1) || '\\1', 'g'), '%', '%25'), chr(1), '%'), '+', ' ')))
       AS decoded_plain
FROM documents
""")
def key_urldecode(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(K.decode_key(F.url_encode("text"))).alias("decoded"),
        F.md5(K.decode_key(F.col("text"))).alias("decoded_plain"),
    )


@query("""
SELECT event_id, 'headlines/raw/' || event_type || '/' || d || '/' || event_type || '_' || d || '.html' AS raw_key
FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS d FROM events)
""")
def raw_key(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", K.raw_key(F.col("event_type"), F.col("ts")).alias("raw_key")
    )


@query("""
SELECT event_id, 'headlines/raw/' || event_type || '_archive_page_1_' || strftime(ts, '%Y%m%d%H%M%S') || '.html'
       AS flat_key
FROM events
""")
def flat_key(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", K.flat_raw_key(F.col("event_type"), F.col("ts")).alias("flat_key")
    )


@query("""
WITH files AS (
  SELECT 'headlines/raw/' || source || '/2025-05-' || lpad(CAST(n_chars % 28 + 1 AS VARCHAR), 2, '0')
         || '/' || doc_id || '.html' AS key, len(string_split(text, chr(10))) AS n_lines
  FROM documents),
keyed AS (
  SELECT key, string_split(key, '/') AS p, CAST(n_lines AS INTEGER) AS n_lines FROM files WHERE n_lines > 1)
SELECT 'headlines/final/periodico=' || p[3] || '/year=2025/month=05/day=' || p[4][9:10] || '/' || p[3]
       || '_' || p[4] || '.csv' AS final_key, max(key) AS key, arg_max(n_lines, key) AS n_lines
FROM keyed GROUP BY 1
""")
def key_collision_last(spark, sf_dir):
    day = F.format_string("%02d", F.col("n_chars") % 28 + 1)
    key = F.format_string("headlines/raw/%s/2025-05-%s/%d.html", "source", day, "doc_id")
    files = table(spark, sf_dir, "documents").select(
        key.alias("key"), F.size(F.split("text", "\n")).alias("n_lines")
    )
    return last_writers(files.filter("n_lines > 1"), AS_OF)


def _fetches(spark, sf_dir):
    """Page fetches that go well or wrong by domain."""
    source = domain(F.col("url"))
    outcome = (
        F.when(source == "net", HTTP_ERROR).when(source == "org", OTHER_ERROR).otherwise(FETCHED)
    )
    error = F.when(source == "net", F.concat(F.lit("500 for "), "url")).when(
        source == "org", F.lit("timed out")
    )
    language = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", language.alias("lang"), source.alias("source"), outcome.alias("outcome"),
        error.alias("error"), "html",
    )


_MESSAGES = """
SELECT page_id, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, s AS source,
       CASE s WHEN 'net' THEN 'Error al descargar de net: 500 for ' || url
              WHEN 'org' THEN 'Error inesperado al procesar org: timed out'
              ELSE 'Successfully uploaded ' || s || ' to headlines/raw/' || s || '/2025-05-26/' || s
                   || '_2025-05-26.html' END AS message
FROM (SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*\\.([a-z]+)', 1) AS s FROM pages)
"""


@query(f"SELECT page_id, source, message FROM ({_MESSAGES})")
def fetch_outcome(spark, sf_dir):
    return fetch_outcomes(_fetches(spark, sf_dir), "page_id", as_of=AS_OF)


@query(f"""
SELECT lang, string_agg(message, '; ' ORDER BY source) AS summary
FROM (SELECT lang, source, arg_max(message, page_id) AS message FROM ({_MESSAGES}) GROUP BY ALL)
GROUP BY lang
""")
def fetch_summary(spark, sf_dir):
    """A batch per language: the last fetch of each source, one message each."""
    outcomes = fetch_outcomes(_fetches(spark, sf_dir), "page_id", "lang", as_of=AS_OF)
    last = outcomes.groupBy("lang", "source").agg(
        F.max_by("message", "page_id").alias("message")
    )
    return outcome_summary(last, "source", ("lang",))


def _events(spark, sf_dir):
    """A notification per page: its file, under an encoded key, and a stray object.
    Every fifth page is of another bucket, every eleventh body is cut off."""

    def record(key):
        bucket = F.when(F.col("page_id") % 5 == 0, "other").otherwise("lake")
        return F.struct(
            F.struct(
                F.struct(bucket.alias("name")).alias("bucket"),
                F.struct(key.alias("key")).alias("object"),
            ).alias("s3")
        )

    page = F.format_string("headlines/raw/caf%%C3%%A9+%d.html", "page_id")
    stray = F.format_string("headlines/raw/%d.txt", "page_id")
    body = F.to_json(F.struct(F.array(record(page), record(stray)).alias("Records")))
    cut = F.when(F.col("page_id") % 11 == 0, F.substring(body, 1, 9)).otherwise(body)
    return table(spark, sf_dir, "pages").select("page_id", cut.alias("body"))


_BUCKET = "CASE WHEN page_id % 5 = 0 THEN 'other' ELSE 'lake' END"
_CUT_OFF = f"""
SELECT page_id, CAST(NULL AS VARCHAR) AS bucket, CAST(NULL AS VARCHAR) AS key, '{BAD_EVENT}' AS error
FROM pages WHERE page_id % 11 = 0
"""


@query(f"""
SELECT page_id, {_BUCKET} AS bucket, unnest(['headlines/raw/café ' || page_id || '.html',
                                             'headlines/raw/' || page_id || '.txt']) AS key, NULL AS error
FROM pages WHERE page_id % 11 <> 0 UNION ALL {_CUT_OFF}
""")
def event_unnest(spark, sf_dir):
    return event_objects(_events(spark, sf_dir))


@query(f"""
SELECT page_id, {_BUCKET} AS bucket, 'headlines/raw/café ' || page_id || '.html' AS key, NULL AS error
FROM pages WHERE page_id % 11 <> 0 UNION ALL {_CUT_OFF}
""")
def event_page_filter(spark, sf_dir):
    return page_events(_events(spark, sf_dir))


@query("""
SELECT 'headlines/raw/café ' || page_id || '.html' AS key, md5(html) AS digest FROM pages
WHERE page_id % 11 <> 0 AND page_id % 5 <> 0
""")
def event_replay(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.format_string("headlines/raw/café %d.html", "page_id").alias("key"), "html"
    )
    landed = pages_of_events(_events(spark, sf_dir), pages, bucket="lake")
    return landed.select("key", F.md5("html").alias("digest"))
