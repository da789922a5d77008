"""Quality rules by robust multivariate outliers, without Python.

Text statistics are transformed to a short vector, and for every language and
source the minimum-covariance-determinant estimate of centre and scatter is
found by concentration steps: of a group's rows those with the least distance
are kept, centre and scatter are taken from them, and distances are measured
anew. Rows far from the final estimate are rejected.

Vectors are kept as whole numbers, so sums are exact and no result depends on
the order in which rows are added. Every step is a map-side combined
aggregation of a narrow table and a join with one row per group; a group may
hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.session import materialize

BLACK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words

SCALE = 4096  # steps per unit of a transformed statistic
STATISTICS = ("word_length", "symbols", "dup_lines", "repeats")
# Spread (as a standard deviation) below which a statistic's variation within a
# group is taken as chance; it is added to every scatter.
LEAST_SPREAD = (0.05, 0.05, 0.12, 0.10)
KEPT_SHARE = 0.75  # of a group's rows in a concentration step
STEPS = 3
LEAST_GROUP = 200  # rows; smaller groups use their language's, then all rows
CUTOFF = 38.0  # squared distance
STEP_BITS = 32  # steps per doubling of a squared distance, when ranking distances
BROADCAST_GROUPS = 50_000  # groups up to this number are broadcast: some 10 MB
SALTS = 32


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, inside a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    """The words of a text, runs without ASCII white space."""
    for white in "\t\n\x0b\x0c\r":  # a split at one plain character is the fast one
        text = F.replace(text, F.lit(white), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in ``words``.

    Windows are hashed to 64 bits and sorted together with their position, which
    takes the place of the hash's low bits; neighbours with equal high bits are
    compared by their full hashes.
    """

    def covered(positions: Column) -> Column:
        steps = F.transform(
            positions, lambda a, i: F.least(F.get(positions, i + 1) - a, F.lit(3))
        )  # the last has no successor, and the least of null and 3 is 3
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, n: total + n)

    def twice(windows: Column) -> Column:
        def with_mask(mask: Column) -> Column:
            def repeated(placed: Column) -> Column:
                def equal(x: Column, y: Column) -> Column:
                    close = x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(mask)) == 0
                    return close & (F.get(windows, position(x)) == F.get(windows, position(y)))

                pairs = F.filter(
                    F.transform(
                        placed,
                        lambda x, i: F.when(
                            equal(x, F.get(placed, i + 1)),
                            F.array(position(x), position(F.get(placed, i + 1))),
                        ),
                    ),
                    lambda pair: pair.isNotNull(),
                )
                return _let(F.sort_array(F.array_distinct(F.flatten(pairs))), covered)

            def position(x: Column) -> Column:
                return x.bitwiseAND(mask).cast("int")

            high = F.bitwise_not(mask)
            placed = F.transform(windows, lambda h, i: h.bitwiseAND(high).bitwiseOR(i.cast("bigint")))
            return _let(F.sort_array(placed), repeated)

        bits = F.length(F.bin(F.size(windows).cast("bigint")))
        return _let(F.pow(F.lit(2.0), bits).cast("bigint") - 1, with_mask)

    def windows(hashes: Column) -> Column:
        three = F.transform(
            hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2))
        )
        return _let(F.slice(three, 1, F.size(hashes) - 2), twice)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= 3, _let(hashes, windows)).otherwise(F.lit(0).cast("bigint"))


def text_statistics(text: Column) -> Column:
    """The base statistics of a whole text as a struct; a null text has none of anything."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(BLACK))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            _let(
                lines, lambda some: (F.size(some) - F.size(F.array_distinct(some))).cast("bigint")
            ).alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("bigint").alias("n_lines"),
        )

    return _let(split_words(text), of_words)


def base_failed(stats: str = "stats") -> Column:
    s = F.col(stats)
    return (s["n_words"] < LEAST_WORDS) | (
        F.lit(100) * s["n_repeat_words"] > F.lit(MOST_REPEATED) * s["n_words"]
    )


def transformed(s: Column) -> list[Column]:
    """The statistics' vector in whole steps of ``1 / SCALE``.

    Logarithm of the mean word length; square roots of symbols per word
    character, of repeated lines per line and of repeated words per word, each
    with some prior counts, so that short texts do not stand out by chance.
    """
    values = [
        F.ln((s["word_chars"] + 50.0) / (s["n_words"] + 10.0)),
        F.sqrt(s["n_symbols"] / (s["word_chars"] + 50.0)),
        F.sqrt(s["n_dup_lines"] / (s["n_lines"] + 4.0)),
        F.sqrt(s["n_repeat_words"] / (s["n_words"] + 20.0)),
    ]
    return [F.round(value * SCALE).cast("bigint") for value in values]


def _names(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _squared_distance(n: int) -> Column:
    """Squared Mahalanobis distance of ``x*`` from centre ``c*``, by the lower
    triangular factor ``l*_*`` of the scatter: forward substitution."""
    solved: list[Column] = []
    total = F.lit(0.0)
    for i in range(n):
        value = F.col(f"x{i}") / F.lit(float(SCALE)) - F.col(f"c{i}")
        for j in range(i):
            value = value - F.col(f"l{i}_{j}") * solved[j]
        solved.append(value / F.col(f"l{i}_{i}"))
        total = total + solved[i] * solved[i]
    return total


def _with_factor(moments: DataFrame, n: int, inflate: float, least: Sequence[float]) -> DataFrame:
    """Centre and Cholesky factor of the scatter from exact sums of x and of x times x."""
    out = moments
    for i in range(n):
        out = out.withColumn(f"c{i}", F.col(f"s{i}").cast("double") / F.col("m") / SCALE)
    for i in range(n):
        for j in range(i + 1):
            mean = F.col(f"q{i}_{j}").cast("double") / F.col("m") / (SCALE * SCALE)
            spread = (mean - F.col(f"c{i}") * F.col(f"c{j}")) * F.lit(inflate)
            if i == j:
                spread = F.greatest(spread, F.lit(0.0)) + F.lit(least[i] ** 2)
            value = spread
            for k in range(j):
                value = value - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(1e-6)))
            else:
                value = value / F.col(f"l{j}_{j}")
            out = out.withColumn(f"l{i}_{j}", value)
    kept = ["level", "g1", "g2", *_names("c", n), *[f"l{i}_{j}" for i in range(n) for j in range(i + 1)]]
    return out.select(*kept)


def _moments(n: int) -> list[Column]:
    wide = "decimal(38,0)"
    sums = [F.sum(F.col(f"x{i}")).alias(f"s{i}") for i in range(n)]
    products = [
        F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).cast(wide).alias(f"q{i}_{j}")
        for i in range(n)
        for j in range(i + 1)
    ]
    return [F.count("*").alias("m"), *sums, *products]


def _attach(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """Join one row per group; beyond the broadcast bound the groups are salted,
    so that a group of a third of all rows is dealt over many tasks."""
    keys = [rows[k].eqNullSafe(groups[f"_{k}"]) for k in ("level", "g1", "g2")]
    if n_groups <= BROADCAST_GROUPS:
        side = F.broadcast(groups)
    else:
        side = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
        keys.append(F.col("salt") == F.col("_salt"))
    return rows.join(side, keys).drop("_level", "_g1", "_g2", "_salt", "salt")


def _named(groups: DataFrame) -> DataFrame:
    return groups.withColumnsRenamed({"level": "_level", "g1": "_g1", "g2": "_g2"})


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows with the group whose estimate judges them: language and source, or
    the language, or all, the first of these with enough rows. And the rows that
    estimates are made from: each row once for every such group it belongs to,
    so that a language's estimate is from all its rows, whatever their source."""
    counts = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = counts.groupBy(F.col("lang").alias("_lang")).agg(
        F.sum("n").alias("n_lang"), F.min("n").alias("n_least")
    )
    both = counts.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "_lang", F.col("source").alias("_source"), "n", "n_lang", "n_least"
    )
    both = materialize(
        both.withColumn(
            "level",
            F.when(F.col("n") >= LEAST_GROUP, 2).when(F.col("n_lang") >= LEAST_GROUP, 1).otherwise(0),
        ),
        "groups",
    )
    n_groups = both.count()
    some_small = not both.filter("level = 0").isEmpty()
    levels = F.array(
        F.when(F.col("level") == 2, 2),
        F.when((F.col("n_lang") >= LEAST_GROUP) & (F.col("n_least") < LEAST_GROUP), 1),
        F.when(F.lit(some_small), 0),
    )
    side = both.select("_lang", "_source", "level", F.array_compact(levels).alias("levels"))
    matches = rows["lang"].eqNullSafe(side["_lang"]) & rows["source"].eqNullSafe(side["_source"])
    if n_groups <= BROADCAST_GROUPS:
        side = F.broadcast(side)
    joined = rows.join(side, matches)
    numbers = [name for name in rows.columns if name.startswith("x")]
    members = joined.select("lang", "source", *numbers, F.explode("levels").alias("level"))

    def keyed(table: DataFrame, columns: Sequence[str]) -> DataFrame:
        level = F.col("level")
        return table.select(
            *columns,
            "level",
            F.when(level >= 1, F.col("lang")).alias("g1"),
            F.when(level == 2, F.col("source")).alias("g2"),
        )

    return keyed(joined, rows.columns), keyed(members, numbers), n_groups


def estimate(rows: DataFrame, n: int, n_groups: int, least: Sequence[float] = LEAST_SPREAD) -> DataFrame:
    """Centre and scatter factor per group by concentration steps.

    ``rows`` has ``level``, ``g1``, ``g2`` and whole ``x0`` to ``x<n-1>``. The
    start is the coordinates' medians with the spread of the middle half. What
    is ranked is the squared distance in ``STEP_BITS`` steps per doubling, so a
    group's percentile is exact with few distinct values; all rows of the last
    step taken are kept.
    """
    keys = ["level", "g1", "g2"]
    middle = rows.groupBy(*keys).agg(
        *[
            F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p{i}")
            for i in range(n)
        ]
    )
    start = middle.select(
        *keys,
        *[(F.col(f"p{i}")[1] / SCALE).alias(f"c{i}") for i in range(n)],
        *[
            (
                F.sqrt(F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / (1.349 * SCALE), F.lit(2.0)) + least[i] ** 2)
                if i == j
                else F.lit(0.0)
            ).alias(f"l{i}_{j}")
            for i in range(n)
            for j in range(i + 1)
        ],
    )
    groups = materialize(start, "start")
    for _ in range(STEPS):
        ranked = _attach(rows, _named(groups), n_groups).select(
            *keys, *_names("x", n),
            F.floor(F.log2(F.lit(1.0) + _squared_distance(n)) * STEP_BITS).cast("int").alias("rank"),
        )
        cut = materialize(
            ranked.groupBy(*keys).agg(F.ceil(F.percentile("rank", F.lit(KEPT_SHARE))).alias("cut")), "cut"
        )
        near = _attach(ranked, _named(cut), n_groups).filter("rank <= cut")
        groups = materialize(
            _with_factor(near.groupBy(*keys).agg(*_moments(n)), n, INFLATION[n], least), "estimate"
        )
    return groups


# What the scatter of the nearest 75 per cent of normal rows has to
# be multiplied by, per number of statistics: 0.75 / P(chi2[n+2] <= the 0.75
# quantile of chi2[n]).
INFLATION = {1: 2.7135, 2: 1.8591, 3: 1.6092, 4: 1.4864, 5: 1.4121, 6: 1.3616}


def judge_quality(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """One row per document: id, base statistics, ``base_failed``, ``kept``,
    ``distance`` (squared, robust), and ``lang``, ``source`` and ``text_key`` (a
    hash of the text), by which rows can be told.

    A row is kept unless the base rule fails or its squared distance exceeds
    ``cutoff``. Estimates are made from the rows that pass the base rule: of the
    language and source, or with fewer than ``LEAST_GROUP`` rows there of the
    whole language, or of all. A null language or source is a value of its own. A null or empty text has no words
    and fails the base rule; its distance is null. Repeated rows count as often
    as they occur and get equal results. No rows give no rows. Only the four
    named columns are read.
    """
    n = len(STATISTICS)
    measured = documents.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        F.xxhash64(F.col(text_col)).alias("text_key"), text_statistics(F.col(text_col)).alias("stats"),
    )
    table = materialize(
        measured.select(
            "id", "lang", "source", "text_key", "stats.*", base_failed().alias("base_failed"),
            *[value.alias(f"x{i}") for i, value in enumerate(transformed(F.col("stats")))],
        ),
        "statistics",
    )
    good = table.filter("NOT base_failed")
    rows, members, n_groups = _grouped(good)
    groups = estimate(members, n, n_groups)
    columns = ["id", "lang", "source", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _attach(rows, _named(groups), n_groups).select(
        *columns, (_squared_distance(n) <= F.lit(cutoff)).alias("kept"), _squared_distance(n).alias("distance")
    )
    failed = table.filter("base_failed").select(
        *columns, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")
    )
    return judged.unionByName(failed).withColumnRenamed("id", id_col)
