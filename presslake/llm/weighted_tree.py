"""Shards by descending a weighted hash tree: region, rack, shard.

A shard draws ``-ln(u) / weight`` with ``u`` a hash of (key, shard number), and a
rack or region draws the least of what the shards below it draw, which is again
a draw by its whole weight. At every level the child with the least draw wins.
So each node gets keys by its weight, and a weight that changes, a new shard's
from nothing included, changes draws only on the way from that shard to the
root: keys move into it or out of it, and everything else stays.

A shard's place in the tree follows from its number. So the number of shards
decides where a key goes, in whatever order they came to be.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.session import materialize

ROWS_PER_BUCKET = 50_000
COPIES_PER_PART = 1_000_000  # of equal rows, written out by one task


class Shard(NamedTuple):
    region: str
    rack: str
    number: int
    weight: float = 1.0


def _shard(number: int, weight: float, racks_per_region: int, shards_per_rack: int) -> Shard:
    region, inside = divmod(number, racks_per_region * shards_per_rack)
    return Shard(f"region{region}", f"rack{inside // shards_per_rack}", number, weight)


def plan_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> list[Shard]:
    """``shards`` equal shards, dealt into full racks and regions in order."""
    return [_shard(n, 1.0, racks_per_region, shards_per_rack) for n in range(shards)]


def add_shard(
    tree: list[Shard], weight: float = 1.0, racks_per_region: int = 2, shards_per_rack: int = 4
) -> list[Shard]:
    """The tree with one more shard, where ``plan_tree`` would have it."""
    number = max((s.number for s in tree), default=-1) + 1
    return [*tree, _shard(number, weight, racks_per_region, shards_per_rack)]


def draw(key: Column, shard: Shard) -> Column:
    """The shard's draw for a key: exponential with its weight as rate, smaller is better."""
    name = F.concat(key, F.lit(f"|{shard.number}"))
    bits = F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double")
    return -F.ln((bits + 0.5) / F.lit(2.0**48)) / F.lit(float(shard.weight))


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """The shard number of a key, read as text; null keys share one shard."""
    if any(s.weight < 0 for s in tree) or not any(s.weight > 0 for s in tree):
        raise ValueError("weights must not be negative, and one must be positive")
    key = F.coalesce(key.cast("string"), F.lit("null"))
    racks: dict[tuple[str, str], list[Column]] = {}
    for s in tree:
        if s.weight > 0:
            drawn = F.struct(draw(key, s).alias("draw"), F.lit(s.number).alias("number"))
            racks.setdefault((s.region, s.rack), []).append(drawn)

    # A node is an array of its children; its draw is that of its best shard.
    def best(children: Column) -> Column:
        return F.array_min(children)

    regions: dict[str, list[Column]] = {}
    for (region, _), shards in racks.items():
        regions.setdefault(region, []).append(best(F.array(*shards)))
    return best(F.array(*[best(F.array(*found)) for found in regions.values()]))["number"]


def place_documents(
    documents: DataFrame,
    tree: list[Shard],
    grown: list[Shard] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``,
    ``slot``, ``grown_shard``.

    The law is ``key``: id and tree alone decide the shard. ``size`` is the
    text's UTF-8 bytes plus 8 (a null text has none), ``text_crc32`` the CRC-32
    of these bytes (0 for a null or empty text). Slots count from 0 in each
    shard without gaps, by hash of the row's values; rows that are equal in id,
    size and checksum take neighbouring slots. Null ids all go to one shard.
    Only id and text are read, so other columns may have any names. No rows give
    no rows. ``grown_shard`` is the shard under ``grown``, by default the tree
    with one more shard.

    Slots need no sort of a shard: rows are counted per shard and hash bucket,
    equal rows as one, and numbered within their bucket.
    """
    grown = add_shard(tree) if grown is None else grown
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = documents.select(
        F.col(id_col).alias("id"),
        (F.octet_length(data).cast("bigint") + 8).alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    # Equal rows become one before the shuffle.
    distinct = rows.groupBy("id", "size", "text_crc32").agg(F.count("*").alias("n"))
    placed = materialize(
        distinct.select(
            "*",
            shard_of(F.col("id"), tree).alias("shard"),
            shard_of(F.col("id"), grown).alias("grown_shard"),
            F.xxhash64("id", "size", "text_crc32").alias("place"),
        ),
        "placed",
    )
    buckets = max(1, -(-placed.count() // (ROWS_PER_BUCKET * max(len(tree), 1))))
    bucket = F.pmod(F.col("place"), F.lit(buckets)).cast("int")
    numbered = placed.withColumn("bucket", bucket)
    counts = numbered.groupBy("shard", "bucket").agg(F.sum("n").alias("m"))
    # A row per bucket of a shard.
    before = Window.partitionBy("shard").orderBy("bucket")
    firsts = counts.select("shard", "bucket", (F.sum("m").over(before) - F.col("m")).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("place", "id", "size", "text_crc32")
    starts = numbered.withColumn("start", F.sum("n").over(inside) - F.col("n"))
    joined = starts.join(firsts, ["shard", "bucket"])
    first = F.col("first") + F.col("start")
    last = F.floor((F.col("n") - 1) / COPIES_PER_PART)
    parts = joined.withColumn("first", first).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    if not placed.filter(F.col("n") > COPIES_PER_PART).isEmpty():
        parts = parts.hint("rebalance", "shard", "place", "part")
    start = F.col("first") + F.col("part") * COPIES_PER_PART
    stop = F.least(start + COPIES_PER_PART, F.col("first") + F.col("n")) - 1
    slots = parts.withColumn("slot", F.explode(F.sequence(start, stop)))
    return slots.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
