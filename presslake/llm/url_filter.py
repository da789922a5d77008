"""URL rules by hashed host-suffix and path-prefix expressions, without Python.

Each URL is expanded into one expression per host suffix and per path prefix
whose length some rule has. An expression meets a rule by equality of a short
hash prefix; the full digests are compared afterwards. Of the rules that hold
for a URL the longest decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
PREFIX_HEX = 8  # digits of the digest that are joined on
BROADCAST_RULES = 100_000  # rules up to this number are broadcast: at most some 20 MB
SALTS = 32  # copies of each rule where rules are too many to broadcast
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    folded = F.translate(host, _UPPER, _LOWER)
    return F.coalesce(folded, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host holds no "/", so the pair can be told from the joined text.
    start = F.when(path == "", F.lit("?")).otherwise(F.lit(""))
    return F.sha2(F.concat(host, start, path).cast("binary"), 256)


def _hashed_rules(rules: DataFrame) -> DataFrame:
    """A row per (host, path): digest, its prefix, whether it blocks."""
    host = F.translate("host", _UPPER, _LOWER)
    one = (
        rules.select(host.alias("host"), "path", (F.col("verdict") == BLOCK).alias("blocks"))
        .filter("host <> '' AND path IS NOT NULL AND blocks IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max(F.col("blocks").cast("int")).alias("blocks"))
    )
    digest = _digest(F.col("host"), F.col("path"))
    return one.select(
        digest.alias("rule_digest"),
        F.substring(digest, 1, PREFIX_HEX).alias("prefix"),
        F.length("path").alias("path_length"),
        "blocks",
    )


def expressions(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """All (host suffix, path prefix) pairs of a URL as an array of structs."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    lengths = F.filter(
        F.array(*[F.lit(n) for n in path_lengths]).cast("array<int>"), lambda n: n <= F.length(path)
    )
    pairs = F.transform(
        suffixes,
        lambda s: F.transform(
            lengths, lambda n: F.struct(s.alias("host"), F.substring(path, F.lit(1), n).alias("path"))
        ),
    )
    return F.flatten(pairs)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has ``verdict``, ``host`` and ``path``. A rule holds for its host
    and the host's subdomains where the URL's path starts with the rule's path.
    The longest rule (host and path together) decides; at equal length the one
    with the longer host, and of equal rules a blocking one. Without a rule,
    ``rule`` is null and the verdict is ``default``; so it is for null or empty
    URLs and for those without ``://``, whose host and path are empty. Repeated
    rows and equal ids are judged one by one. Only the id and the URL are read,
    so other columns may have any names. Rules without a host are not used.
    """
    hashed = _hashed_rules(rules)
    lengths, n_rules = hashed.agg(F.sort_array(F.collect_set("path_length")), F.count("*")).first()
    host, path = host_and_path(F.col(url_col))
    # The scan is read in the same order again, so the number stays with its row.
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        host.alias("host"), path.alias("path"),
    )
    spread = rows.select("*", F.explode_outer(expressions(F.col("host"), F.col("path"), lengths)).alias("e"))
    digest = _digest(F.col("e.host"), F.col("e.path"))
    probes = spread.select(
        "row", "id", "host", "path",
        digest.alias("digest"), F.substring(digest, 1, PREFIX_HEX).alias("prefix"),
        F.length("e.host").alias("host_length"), F.length("e.path").alias("rule_path_length"),
    )
    hashed = hashed.drop("path_length")
    if n_rules <= BROADCAST_RULES:
        met = probes.join(F.broadcast(hashed), "prefix", "left")
    else:
        salted = hashed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
        met = probes.withColumn("salt", salt).join(salted, ["prefix", "salt"], "left")
    # Total length, then host length, then blocking: one number, so that the
    # reduction is a hash aggregate that is complete before the shuffle.
    total = (F.col("host_length") + F.col("rule_path_length")).cast("bigint")
    weight = F.when(
        F.col("digest") == F.col("rule_digest"),
        total * F.lit(2**32) + F.col("host_length") * F.lit(2) + F.col("blocks"),
    )
    best = met.groupBy("row", "id", "host", "path").agg(F.max(weight).alias("best"))
    taken = F.shiftrightunsigned(F.col("best").bitwiseAND(F.lit(2**32 - 1)), 1).cast("int")
    whole = F.shiftrightunsigned("best", 32).cast("int")
    rule = F.concat(
        F.substring("host", F.length("host") - taken + 1, taken),
        F.substring("path", F.lit(1), whole - taken),
    )
    verdict = F.when(F.col("best").isNull(), F.lit(default)).otherwise(
        F.when(F.col("best").bitwiseAND(F.lit(1)) == 1, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    )
    return best.select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict")
    )
