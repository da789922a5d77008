"""SQL for the queries that SQL can express, in DuckDB's dialect.

They compare everything with everything, as a plain check on small tables may.
"""

from __future__ import annotations

from collections.abc import Mapping

URL_FILTER = r"""
WITH rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), cut AS (
    SELECT page_id, url,
           CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest
    FROM pages
), parts AS (
    SELECT page_id, url,
           coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '')
               AS path
    FROM cut
)
SELECT page_id, p.host, p.path,
       arg_max(r.host || r.path, (length(r.host || r.path), length(r.host))) AS rule,
       coalesce(arg_max(r.verdict, (length(r.host || r.path), length(r.host))), 'allow') AS verdict
FROM (SELECT *, row_number() OVER () AS n FROM parts) p
LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY n, page_id, p.host, p.path
"""

# Reachability over the pairs of ``links``, then the least id reached.
_COMPONENTS = """
reach(a, b) AS (
    SELECT a, b FROM links
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a AS id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
"""

VECTOR_PAIRS = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
      AND list_bool_or([x <> 0 FOR x IN embedding])
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
      ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
     AND list_cosine_similarity(x.v, y.v) >= 0.93
), counts AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a), {_COMPONENTS}
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON counts.id = vec_id LEFT JOIN least ON least.id = vec_id
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id,
           CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)])
           END AS s
    FROM words
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
    FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id <> y.doc_id
     AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n
    GROUP BY x.doc_id, y.doc_id
), links AS (SELECT a, b FROM shared WHERE 100 * c >= 90 * (na + nb - c)), {_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN least ON least.id = doc_id
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_digests(known: Mapping[str, list[str]], words: Mapping[str, str], copyright_line: str) -> str:
    texts = ", ".join(f"({_text(name)}, {_text(text)})" for name, some in known.items() for text in some)
    pairs = ", ".join(f"{_text(a)}: {_text(b)}" for a, b in words.items())

    def canonical(column: str) -> str:
        lines = f"regexp_replace(lower({column}), {_text(copyright_line)}, chr(10), 'g')"
        blanks = f"trim(regexp_replace({lines}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        return f"array_to_string([coalesce((MAP {{{pairs}}})[w], w) FOR w IN string_split({blanks}, ' ')], ' ')"

    return f"""
    WITH known AS (
        SELECT sha256(c) AS digest, min(licence) AS licence
        FROM (SELECT licence, {canonical("text")} AS c FROM (VALUES {texts}) t(licence, text))
        WHERE c <> '' GROUP BY sha256(c)
    ), read AS (
        SELECT doc_id, CASE WHEN text IS NOT NULL THEN sha256({canonical("text")}) END AS digest FROM documents
    )
    SELECT doc_id, read.digest, licence FROM read LEFT JOIN known ON known.digest = read.digest
    """


def robust_outliers(
    scale: int, least: tuple[float, ...], inflation: float, share: float, steps: int, step_bits: int,
    least_group: int, cutoff: float, least_words: int, most_repeated: int,
) -> str:
    n = len(least)
    lower = [(i, j) for i in range(n) for j in range(i + 1)]
    keys = "level, g1, g2"
    same = "r.level = g.level AND r.g1 IS NOT DISTINCT FROM g.g1 AND r.g2 IS NOT DISTINCT FROM g.g2"
    xs = ", ".join(f"x{i}" for i in range(n))

    def solved(name: str) -> tuple[str, str]:
        """A chain of lateral columns ``y*`` and the squared distance."""
        terms = []
        for i in range(n):
            value = f"(x{i} / {float(scale)} - c{i})"
            for j in range(i):
                value = f"({value} - l{i}_{j} * y{j})"
            terms.append(f"{value} / l{i}_{i} AS y{i}")
        return ", ".join(terms), "0.0" + "".join(f" + y{i} * y{i}" for i in range(n))

    chain, total = solved("y")
    parts = []
    for step in range(1, steps + 1):
        parts.append(f"""
ranked{step} AS (
    SELECT {keys}, {xs}, floor(ln(1.0 + ({total})) / ln(2.0) * {step_bits})::INT AS rank
    FROM (SELECT r.level, r.g1, r.g2, {xs}, {chain} FROM members r JOIN est{step - 1} g ON {same})
), cut{step} AS (
    SELECT {keys}, ceil(quantile_cont(rank, {share})) AS cut FROM ranked{step} GROUP BY {keys}
), sums{step} AS (
    SELECT r.level, r.g1, r.g2, count(*) AS m,
           {", ".join(f"sum(x{i})::DOUBLE AS s{i}" for i in range(n))},
           {", ".join(f"sum(x{i}::HUGEINT * x{j})::DOUBLE AS q{i}_{j}" for i, j in lower)}
    FROM ranked{step} r JOIN cut{step} g ON {same} WHERE rank <= cut GROUP BY r.level, r.g1, r.g2
), mean{step} AS (
    SELECT *, {", ".join(f"s{i} / m / {scale} AS c{i}" for i in range(n))} FROM sums{step}
), est{step} AS (SELECT {keys}, {", ".join(f"c{i}" for i in range(n))}, {_factor(lower, least, scale, inflation)}
    FROM mean{step})""")
    start = ", ".join(
        [f"p{i}[2] / {scale} AS c{i}" for i in range(n)]
        + [
            f"sqrt(pow((p{i}[3] - p{i}[1]) / {1.349 * scale}, 2.0) + {least[i] ** 2!r}) AS l{i}_{i}" if i == j
            else f"0.0::DOUBLE AS l{i}_{j}"
            for i, j in lower
        ]
    )
    return rf"""
WITH read AS (
    SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
       list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM read
), windows AS (
    SELECT row, i, w[i : i + 2] AS gram
    FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS c FROM windows) WHERE c > 1
), repeated AS (
    SELECT row, sum(least(3, coalesce(following - i, 3)))::BIGINT AS n
    FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS following FROM twice) GROUP BY row
), base AS (
    SELECT words.row, doc_id, lang, source, len(w)::BIGINT AS n_words,
           length(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
    FROM words LEFT JOIN repeated ON repeated.row = words.row
), judged AS (
    SELECT *, n_words < {least_words} OR 100 * n_repeat_words > {most_repeated} * n_words AS base_failed,
           round(ln((word_chars + 50.0::DOUBLE) / (n_words + 10.0::DOUBLE)) * {scale})::BIGINT AS x0,
           round(sqrt(n_symbols / (word_chars + 50.0::DOUBLE)) * {scale})::BIGINT AS x1,
           round(sqrt(n_dup_lines / (n_lines + 4.0::DOUBLE)) * {scale})::BIGINT AS x2,
           round(sqrt(n_repeat_words / (n_words + 20.0::DOUBLE)) * {scale})::BIGINT AS x3
    FROM base
), leveled AS (
    SELECT *, CASE WHEN count(*) OVER (PARTITION BY lang, source) >= {least_group} THEN 2
                   WHEN count(*) OVER (PARTITION BY lang) >= {least_group} THEN 1 ELSE 0 END AS level
    FROM judged WHERE NOT base_failed
), members AS (
    SELECT *, CASE WHEN level >= 1 THEN lang END AS g1, CASE WHEN level = 2 THEN source END AS g2 FROM leveled
), middle AS (
    SELECT {keys}, {", ".join(f"quantile_cont(x{i}::DOUBLE, [0.25, 0.5, 0.75]) AS p{i}" for i in range(n))}
    FROM members GROUP BY {keys}
), est0 AS (SELECT {keys}, {start} FROM middle), {", ".join(parts)},
measured AS (SELECT row, {total} AS d FROM (SELECT r.row, {xs}, {chain} FROM members r JOIN est{steps} g ON {same}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(d <= {cutoff}, FALSE) AS kept
FROM judged LEFT JOIN measured ON measured.row = judged.row
"""


def _factor(lower, least, scale: int, inflation: float) -> str:
    """Cholesky factor of the scatter, each entry from the ones before it."""
    out = []
    for i, j in lower:
        value = f"((q{i}_{j} / m / {scale * scale}) - c{i} * c{j}) * {inflation}"
        if i == j:
            value = f"(greatest({value}, 0.0) + {least[i] ** 2!r})"
        for k in range(j):
            value = f"({value} - l{i}_{k} * l{j}_{k})"
        out.append(f"sqrt(greatest({value}, 1e-6)) AS l{i}_{i}" if i == j else f"{value} / l{j}_{j} AS l{i}_{j}")
    return ", ".join(out)

CHUNK_RECIPES = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

FILTER_AUDIT = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), flagged AS (
    SELECT part,
           [len(w) < 200,
            100 * len(list_distinct(w)) < 50 * len(w),
            100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
            regexp_matches(t, '[#$%&*|]'),
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
           doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
           doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
    FROM words
), masks AS (
    SELECT part, fails, good, toxic, count(*) AS n FROM flagged GROUP BY ALL
), letters(f, p) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)
), sequences AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.p, b.p, c.p, d.p, e.p] AS ps
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.p, b.p, c.p, d.p, e.p])) = 5
), steps AS (
    SELECT filter_order, step, ps[step] AS own, ps[1 : step - 1] AS before
    FROM sequences, (SELECT unnest(range(1, 6)) AS step)
), met AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS failing,
           len([p FOR p IN before IF fails[p]]) > 0 AS gone, len([x FOR x IN fails IF x]) AS failed
    FROM masks, steps
), counted AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN failing AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN failing AND failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM met GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

SIGNATURE_SEARCH = r"""
WITH sized AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents WHERE text IS NOT NULL
), held AS (SELECT doc_id, r, w, len(w)::BIGINT AS n FROM sized WHERE len(w) > 0
), totals AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM held
), asked AS (
    SELECT item_id, t, count(*)::BIGINT AS c
    FROM (SELECT item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
    GROUP BY ALL
), found AS (
    SELECT r, doc_id, n, t, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, n, unnest(w) AS t FROM held) WHERE t IN (SELECT t FROM asked) GROUP BY ALL
), weights AS (
    SELECT t, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)))::BIGINT AS weight
    FROM (SELECT t, count(*)::BIGINT AS df FROM found GROUP BY t), totals
), scores AS (
    SELECT item_id, r, doc_id,
           sum(c * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
    FROM asked JOIN found USING (t) JOIN weights USING (t), totals GROUP BY ALL
), placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 10
"""
