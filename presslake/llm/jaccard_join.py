"""N-gram Jaccard join with adaptive multi-match prefixes, exact to the threshold.

A document's set of word shingles is ordered from rare to frequent (by a table
of hashed counts over all documents), and only a prefix of it is indexed. Two
sets that reach the threshold share at least ``l`` tokens of their prefixes if
both are lengthened by ``l - 1`` tokens. Each document takes the ``l`` for which
its estimated cost is least: the postings it reads, and the candidates it has
to have verified, of which there are fewer the more matches are asked for.

Equal sets are one class. Before candidates are formed, every class is compared
with one class that shares rare tokens with it and most with others; what that
links falls into components, and candidates are then only sought between
different components. A pair must also have sketches of the whole sets that can
differ by no more than the sets may. So large groups of near copies are not
expanded into pairs, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.components import connected_components
from presslake.llm.counters import summed_table
from presslake.llm.words import blocks, shingle_hashes, tidy, word_hashes
from presslake.session import materialize

ORDER_BITS = 22  # counters that tell rare from frequent tokens; only the order depends on them
LEVELS = 4  # most matches a prefix may ask for
VERIFY_COST = 40  # a verified candidate costs as much as reading so many postings
FOLLOWERS = 400  # texts compared with one text in a group of a verifying task
SKETCH_WORDS = 8  # 64-bit words of a class's sketch
BROADCAST_KEYS = 1_000_000  # 8-byte keys that may be broadcast


_SKETCH = [f"sketch{w}" for w in range(SKETCH_WORDS)]


def distinct_shingles(texts: pa.Array, size: int):
    """The sorted distinct shingle hashes of each text."""
    words, rows = word_hashes(texts)
    hashes, starts = shingle_hashes(words, rows, size)
    for a, b in zip(starts[:-1], starts[1:]):
        yield np.unique(hashes[a:b])


def frequency_classes(documents: DataFrame, text_col: str, size: int) -> np.ndarray:
    """Per hashed counter the logarithm of its count over all documents, a byte each.

    Counters that several shingles share only blur the order.
    """

    def entries(block):
        own = [np.empty(0, np.uint64), *distinct_shingles(block.column(text_col), size)]
        return (np.concatenate(own) >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1

    def classes(sums):
        return np.ceil(2 * np.log2(np.maximum(sums, 1))).astype(np.uint8)

    return summed_table(documents, text_col, 1 << ORDER_BITS, entries, classes)


def prefix_length(n: int, share: Fraction, level: int) -> int:
    """Tokens of a set of ``n`` that are indexed if ``level`` matches are asked for."""
    least = -(-n * share.numerator // share.denominator)
    return min(n, n - least + level)


def odd_sketch(tokens: np.ndarray) -> np.ndarray:
    """For each of some bits, whether an odd number of the set's tokens fall on it.

    A token that only one of two sets has changes one bit, so sketches differ in
    no more bits than their sets in tokens.
    """
    place = (tokens & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    data = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(data[:8], "little", signed=True), int.from_bytes(data[8:], "little", signed=True)


def sketches(documents: DataFrame, size: int, share: Fraction, order: np.ndarray) -> DataFrame:
    """A row per document of ``id``, ``text`` and ``text_key``: digest of its set,
    the set's size, its odd sketch and its prefix, rare tokens first."""
    carried = documents.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        classes = carried.value
        for block in blocks(batches, "text"):
            k1, k2, sizes, prefixes, marks = [], [], [], [], []
            for tokens in distinct_shingles(block.column("text"), size):
                n = len(tokens)
                a, b = _digest(tokens)
                rank = classes[(tokens >> np.uint64(64 - ORDER_BITS)).astype(np.int64)].astype(np.uint64)
                ranked = (rank << np.uint64(56)) | (tokens >> np.uint64(8))
                k = prefix_length(n, share, LEVELS)
                if 0 < k < n:
                    ranked = np.partition(ranked, k - 1)[:k]
                k1.append(a)
                k2.append(b)
                sizes.append(n)
                marks.append(odd_sketch(tokens))
                prefixes.append(np.sort(ranked).astype(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *prefixes])
            sketch = np.concatenate([np.empty(0, np.int64), *marks]).reshape(-1, SKETCH_WORDS)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"), block.column("text_key"), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    *[pa.array(np.ascontiguousarray(sketch[:, w])) for w in range(SKETCH_WORDS)],
                ],
                ["id", "text_key", "k1", "k2", "n", "prefix", *_SKETCH],
            )

    kind = documents.schema["id"].dataType.simpleString()
    return documents.mapInArrow(
        tidy(run),
        f"id {kind}, text_key bigint, k1 bigint, k2 bigint, n bigint, prefix array<bigint>, "
        + ", ".join(f"{w} bigint" for w in _SKETCH),
    )


def _verified(
    pairs: DataFrame, texts: DataFrame, size: int, share: Fraction
) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets reach the threshold.

    ``texts`` has (node, text). The texts of all ``b`` of one ``a`` stream past
    the set of ``a``; an ``a`` with many of them is dealt over several groups.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(FOLLOWERS)).cast("int").alias("parts"))
    sizes = materialize(sizes, "parts")
    first = texts.join(sizes, texts["node"] == sizes["a"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(None).cast("bigint").alias("b"), "text",
    )
    dealt = pairs.join(sizes, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b"
    )
    rest = dealt.join(texts, dealt["b"] == texts["node"]).select("a", "part", "b", "text")
    grouped = first.unionByName(rest).repartition("a", "part").sortWithinPartitions(
        "a", "part", F.col("b").asc_nulls_first()
    )
    top, bottom = share.numerator, share.denominator

    def run(batches):
        key, base = None, np.empty(0, np.uint64)
        for block in blocks(batches, "text"):
            a, b = [], []
            columns = zip(
                block.column("a").to_pylist(), block.column("part").to_pylist(), block.column("b").to_pylist(),
                distinct_shingles(block.column("text"), size),
            )
            for one, part, other, tokens in columns:
                if other is None:
                    key, base = (one, part), tokens
                elif key == (one, part):
                    shared = len(np.intersect1d(base, tokens, assume_unique=True))
                    if bottom * shared >= top * (len(base) + len(tokens) - shared) and shared:
                        a.append(one)
                        b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return grouped.mapInArrow(tidy(run), "a bigint, b bigint")


def _texts_of(documents: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the wanted classes: one text for each."""
    wanted = materialize(
        classes.select("node", "text_key").join(nodes.distinct(), "node", "left_semi"), "wanted"
    )
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    found = documents.select("text_key", "text").join(side, "text_key")
    return materialize(found.groupBy("node").agg(F.first("text").alias("text")), "texts")


def link_documents(
    documents: DataFrame,
    size: int = 5,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``group``, ``text_key``.

    A document's set are the distinct runs of ``size`` words of its lower-cased
    (A to Z) text, or the whole sequence if it has fewer words. Documents link
    if the Jaccard coefficient of their sets is ``threshold`` or more, compared
    as a fraction of whole numbers. ``component_id`` is the least id reachable
    by links, itself included; ``group`` is the same for the rows of one
    component and null for a document without words. Null and empty texts, and
    texts of white space, have an empty set and link with nothing. Repeated rows
    link with one another. A null id never becomes a component id unless its
    component has no other. Only id and text are read; no rows give no rows.
    """
    share = Fraction(threshold).limit_denominator(10_000)
    if not 0 < share <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    rows = documents.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key")
    )
    order = frequency_classes(rows, "text", size)
    table = materialize(sketches(rows, size, share, order), "sketches")
    worded = table.filter("n > 0")
    classes = worded.groupBy("k1", "k2").agg(
        F.min("id").alias("least"), F.min("text_key").alias("text_key"), F.first("n").alias("n"),
        F.first("prefix").alias("prefix"), *[F.first(w).alias(w) for w in _SKETCH],
    )
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    links = _links(rows.filter("text IS NOT NULL"), classes, size, share)
    components = connected_components(links)
    named = materialize(
        classes.join(components, "node", "left").select(
            "k1", "k2", "least", F.coalesce("component", "node").alias("group")
        ),
        "named",
    )
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    final = named.join(least, "group").select("k1", "k2", "group", "component_id")
    joined = worded.select("id", "n", "k1", "k2", "text_key").join(final, ["k1", "k2"])
    alone = table.filter("n = 0").select(
        "id", "n", F.col("id").alias("component_id"), F.lit(None).cast("bigint").alias("group"), "text_key"
    )
    return joined.select("id", "n", "component_id", "group", "text_key").unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "group", "text_key"
    )


def _links(texts: DataFrame, classes: DataFrame, size: int, share: Fraction) -> DataFrame:
    top, bottom = F.lit(share.numerator), F.lit(share.denominator)
    least = F.ceil(F.col("n") * top / bottom)  # tokens a partner must share
    tokens = classes.select("node", "n", F.posexplode("prefix").alias("i", "token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    level = F.greatest(F.lit(1), F.col("i") - (F.col("n") - least).cast("int") + 1)
    postings = materialize(
        tokens.join(counts, "token").select("token", "node", "n", "i", level.cast("int").alias("level"), "df"),
        "postings",
    )
    first = materialize(_heads(postings, classes, least, share), "pairs")
    near = materialize(
        _verified(first, _texts_of(texts, classes, _nodes(first)), size, share), "links"
    )
    # Then all other candidates between components.
    components = connected_components(near)
    known = postings.join(components, "node", "left").select(
        "token", "node", "n", "i", "level", "df", F.coalesce("component", "node").alias("component")
    )
    known = materialize(known, "known")
    mixed = known.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = mixed.filter("lo <> hi").select("token")
    marks = classes.select("node", *_SKETCH)
    open_ = materialize(known.join(mixed, "token").join(marks, "node"), "open")
    levels = _levels(open_, least)
    probes = open_.join(levels, "node").filter("level <= asked").select(
        "token", F.col("node").alias("r"), F.col("n").alias("nr"), F.col("i").alias("ir"),
        F.col("component").alias("cr"), "asked", *[F.col(w).alias(f"{w}r") for w in _SKETCH],
    )
    index = open_.select(
        "token", F.col("node").alias("s"), F.col("n").alias("ns"), F.col("i").alias("js"),
        F.col("component").alias("cs"), F.col("level").alias("ls"), *[F.col(w).alias(f"{w}s") for w in _SKETCH],
    )
    smaller = (F.col("ns") < F.col("nr")) | ((F.col("ns") == F.col("nr")) & (F.col("s") < F.col("r")))
    able = _can_link(F.col("nr"), F.col("ns"), [(F.col(f"{w}r"), F.col(f"{w}s")) for w in _SKETCH], share)
    # Of a pair that reaches the threshold every shared token fulfils this.
    reach = F.least("ir", "js") + F.least(F.col("nr") - F.col("ir"), F.col("ns") - F.col("js"))
    both = (F.col("nr") + F.col("ns")) * top
    met = probes.join(
        index,
        (probes["token"] == index["token"]) & (F.col("ls") <= F.col("asked")) & (F.col("cr") != F.col("cs"))
        & smaller & able & (reach * (top + bottom) >= both),
    )
    # All shared tokens up to the last one met are counted, so only what follows it can add to them.
    after = F.least(F.col("nr") - 1 - F.col("last_r"), F.col("ns") - 1 - F.col("last_s"))
    pairs = (
        met.groupBy("r", "s", "asked", "nr", "ns")
        .agg(F.count("*").alias("c"), F.max("ir").alias("last_r"), F.max("js").alias("last_s"))
        .filter((F.col("c") >= F.col("asked")) & ((F.col("c") + after) * (top + bottom) >= both))
        .select(F.col("r").alias("a"), F.col("s").alias("b"))
    )
    second = materialize(pairs, "pairs")
    far = _verified(second, _texts_of(texts, classes, _nodes(second)), size, share)
    return near.unionByName(materialize(far, "links"))


def _can_link(n, m, sketches, share: Fraction):
    """Whether sets of ``n`` and ``m`` tokens with these sketches can reach the threshold."""
    top, bottom = F.lit(share.numerator), F.lit(share.denominator)
    large_enough = (F.least(n, m) * bottom) >= (F.greatest(n, m) * top)
    differ = F.lit(0)
    for a, b in sketches:
        differ = differ + F.bit_count(a.bitwiseXOR(b))
    return large_enough & (differ * (top + bottom) <= (n + m) * (bottom - top))


def _heads(postings: DataFrame, classes: DataFrame, least, share: Fraction) -> DataFrame:
    """(a, b): every class ``b`` with the one ``a`` that heads most of its tokens.

    A token's head is the class whose prefix is shared most, counted by length:
    among the copies of a text that is the least altered one.
    """
    length = F.first(F.col("n") - least + LEVELS)
    shared = postings.groupBy("node").agg((F.sum("df") / length).alias("shared"))
    headed = postings.join(shared, "node").groupBy("token").agg(F.max(F.struct("shared", "node")).alias("head"))
    heads = (
        postings.join(headed.select("token", F.col("head.node").alias("head")), "token")
        .filter("node <> head")
        .groupBy("node", "head")
        .agg(F.count("*").alias("c"))
    )
    best = heads.groupBy("node").agg(F.max(F.struct("c", "head")).alias("best")).select("node", "best.head")
    own = classes.select("node", F.col("n").alias("nb"), *[F.col(w).alias(f"{w}b") for w in _SKETCH])
    other = classes.select(F.col("node").alias("head"), F.col("n").alias("na"), *[F.col(w).alias(f"{w}a") for w in _SKETCH])
    able = _can_link(F.col("na"), F.col("nb"), [(F.col(f"{w}a"), F.col(f"{w}b")) for w in _SKETCH], share)
    return (
        best.join(own, "node").join(other, "head").filter(able)
        .select(F.col("head").alias("a"), F.col("node").alias("b"))
    )


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def _levels(postings: DataFrame, least) -> DataFrame:
    """(node, asked): the matches each class asks for, by least estimated cost.

    With ``l`` matches a class reads the postings of its prefix for ``l``, and a
    candidate is met at least ``l`` times, so there are at most a fraction
    ``1 / l`` as many candidates to verify. A class whose partners need not
    share ``l`` tokens cannot ask for as many.
    """
    reads = [
        F.sum(F.when(F.col("level") <= k, F.col("df") - 1).otherwise(0)).alias(f"reads{k}")
        for k in range(1, LEVELS + 1)
    ]
    sums = postings.groupBy("node").agg(F.first(least).alias("least"), *reads)
    costs = [
        F.when(F.col("least") >= k, F.col(f"reads{k}") * (1 + VERIFY_COST / k)) for k in range(1, LEVELS + 1)
    ]
    cheapest = F.least(*costs)
    asked = F.coalesce(*[F.when(cost <= cheapest, F.lit(k)) for k, cost in enumerate(costs, 1)])
    return sums.select("node", asked.alias("asked"))
