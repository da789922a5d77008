"""Exact duplicates by recipes of content-defined chunks, without Python.

Every text is cut where its own content says, so equal passages give equal
chunks wherever they stand. Chunks are reduced to their distinct texts: each
moves once per task, however many documents hold it. An identifier is a 64-bit
hash, verified by comparing the texts of all chunks that share it; an
identifier of two different chunks is struck off, and a recipe then spells
those chunks out. A document is its ordered list of identifiers (8 bytes for
some hundred characters), and only these lists are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.rows import COPIES_PER_PART, numbered_copies
from presslake.session import materialize

LEAST_CHARS, MOST_CHARS = 500, 8_000
# A cut comes after a break between certain letters, about every 20th word, or
# after a full stop of a script without blanks.
CUT = r"(?:[dlnrt]\s(?=[a-hA-H])|[。！？])"
STRUCK_OFF = 10_000  # identifiers of several chunks that recipes can name one by one


def chunk_pattern(least: int = LEAST_CHARS, most: int = MOST_CHARS) -> str:
    return rf"(?s).{{{least},{most}}}?{CUT}|.{{1,{most}}}"


def chunks(text: Column, pattern: str) -> Column:
    """The text in pieces that make it up again; an empty text has none."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifier(chunk: Column, bits: int = 64) -> Column:
    hashed = F.xxhash64(chunk)
    return hashed if bits == 64 else F.shiftrightunsigned(hashed, 64 - bits)


def struck_off(cut: DataFrame, bits: int) -> DataFrame:
    """Identifiers under which the chunks of ``cut`` have more than one text."""
    each = cut.select(F.explode("chunks").alias("chunk"))
    distinct = each.groupBy(identifier(F.col("chunk"), bits).alias("hash"), "chunk").agg(F.lit(1).alias("one"))
    return distinct.groupBy("hash").agg(F.count("*").alias("texts")).filter("texts > 1").select("hash")


def recipe(bad: list[int] | None, bits: int) -> list[Column]:
    """The ordered identifiers of ``chunks``, and the chunks they do not stand for:
    those of ``bad`` identifiers, or all if there is no list of these."""
    listed = F.transform("chunks", lambda c: identifier(c, bits)).alias("ids")
    if bad is None:
        return [listed, F.col("chunks").alias("spelled")]
    if not bad:
        return [listed, F.array().cast("array<string>").alias("spelled")]
    known = F.array(*[F.lit(h).cast("bigint") for h in bad])
    return [listed, F.filter("chunks", lambda c: F.array_contains(known, identifier(c, bits))).alias("spelled")]


def group_exact(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_CHARS,
    most: int = MOST_CHARS,
    bits: int = 64,
    limit: int = STRUCK_OFF,
) -> DataFrame:
    """A row per document: its id, ``keep_id`` (the greatest id of the rows with the
    same text), ``group_size``, ``kept`` and ``text_sha256``.

    A null text counts as empty; all empty texts are one group. Texts are equal if
    all their bytes are. A null id is less than any other; of rows that repeat
    the id that stays, one is kept. Other columns of the input are not read. An
    empty table gives no rows. ``bits`` shortens the identifiers: with fewer, more
    of them are struck off, and the result is the same; beyond ``limit`` of them
    all chunks are spelled out, which compares whole texts.

    A group may hold any share of the rows: equal recipes are counted per task
    and id before they meet, and the counts join their groups without a hint, so
    that adaptive execution splits a large group.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = documents.select(
        F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha"), chunks(text, chunk_pattern(least, most)).alias("chunks")
    )
    bad = [row.hash for row in struck_off(cut, bits).limit(limit + 1).collect()]
    named = recipe(bad if len(bad) <= limit else None, bits)
    rows = cut.select("id", "sha", *named).groupBy("ids", "spelled", "sha", "id").agg(F.count("*").alias("n"))
    rows = materialize(rows, "recipes")
    groups = rows.groupBy("ids", "spelled").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    # Groups of one row need no join.
    repeated = materialize(
        groups.filter("group_size > 1").select(
            F.col("ids").alias("_ids"), F.col("spelled").alias("_spelled"), "keep_id", "group_size"
        ),
        "groups",
    )
    judged = rows.join(repeated, (F.col("ids") == F.col("_ids")) & (F.col("spelled") == F.col("_spelled")), "left")
    grouped = F.col("group_size").isNotNull()
    judged = judged.select(
        F.col("id").alias(id_col),
        F.when(grouped, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("sha").alias("text_sha256"),
        "n",
    )
    stays = F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    many = not rows.filter(F.col("n") > COPIES_PER_PART).isEmpty()
    return numbered_copies(judged, "n", "copy", many).select(
        id_col, "keep_id", "group_size", stays.alias("kept"), "text_sha256"
    )
