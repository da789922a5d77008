"""Titles: normal form, keyword labels, tokens."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, digits and underscore of every script, as Unicode defines them.
WORD = r"\p{L}\p{N}_"

# The keyword patterns of each label, in the order they apply.
HEADLINE_KEYWORDS: tuple[tuple[int, str], ...] = (
    (1, "fútbol|deporte|gol|equipo"),
    (2, "política|gobierno|elecciones|congreso"),
    (3, "salud|pandemia|medicina|enfermedad"),
    (4, "cultura|cine|música|arte"),
)


def normalize(title: Column) -> Column:
    """Lower case, each non-word character a space, ends trimmed; null is empty."""
    lowered = F.lower(F.coalesce(title.cast("string"), F.lit("")))
    return F.trim(F.regexp_replace(lowered, f"[^{WORD} ]", " "))  # a space stays one


def has_words(title: Column) -> Column:
    """Whether the normal form of a title is not empty; stops at its first word."""
    return F.coalesce(title.cast("string").rlike(f"[{WORD}]"), F.lit(False))


def _occurs(title: Column, pattern: str) -> Column:
    """Whether a pattern occurs; its plain alternatives are looked up as text."""
    parts = pattern.split("|")
    if not all(part and part.replace("_", "a").isalnum() for part in parts):
        return title.rlike(pattern)
    return reduce(Column.__or__, [title.contains(part) for part in parts])


def keyword_label(
    title: Column, rules: Sequence[tuple[int, str]] = HEADLINE_KEYWORDS, default: int = 0
) -> Column:
    """The label of the last rule whose pattern occurs anywhere in the title."""
    label = None
    for value, pattern in reversed(rules):
        hit = _occurs(title, pattern)
        label = F.when(hit, value) if label is None else label.when(hit, value)
    return F.lit(default) if label is None else label.otherwise(default)


def tokens(text: Column) -> Column:
    """Runs of two or more word characters, lower-cased, in text order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"([{WORD}]{{2,}})"))
