import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.functions.text import keyword_label, normalize, tokens
from presslake.plans.classify import labelled_titles, preview, require_column


def python_normal(title):
    return re.sub(r"\W", " ", (title or "").lower()).strip()


def column(spark, values, function):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = frame.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


TITLES = ["Fútbol: ¡GOL!  hoy", None, "", "¿?", "gol_1 a-b", "ÑANDÚ\t1º", "½ kg", "日本語 テスト", " a "]


def test_normalize(spark):
    assert column(spark, TITLES, normalize) == [python_normal(t) for t in TITLES]
    assert column(spark, ["a - b"], normalize) == ["a   b"]


# Scripts whose letters both engines' Unicode versions know alike.
PROSE = st.text(st.characters(codec="utf-8", max_codepoint=0x2FF, exclude_characters="\x00İ"), max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PROSE, min_size=20, max_size=40))
def test_normalize_and_tokens_agree_with_python(spark, values):
    assert column(spark, values, normalize) == [python_normal(v) for v in values]
    expected = [re.findall(r"(?u)\b\w\w+\b", v.lower()) for v in values]
    assert column(spark, values, tokens) == expected


@pytest.mark.parametrize(
    "title, label",
    [
        ("distrito denuncia por golpear a un niño", 1),
        ("parte médico", 4),
        ("gol y cine", 4),
        ("el gobierno y el fútbol", 2),
        ("elecciones y salud", 3),
        ("futbol sin acento", 0),
        ("congreso", 2),
        ("", 0),
    ],
)
def test_headline_labels(spark, title, label):
    assert column(spark, [title], keyword_label) == [label]


def test_labelled_titles(spark):
    rows = [("a", "¡Gol!"), ("b", None), ("c", "¿?"), ("d", "Música  clásica")]
    found = labelled_titles(spark.createDataFrame(rows, "category string, title string"))
    assert sorted(map(tuple, found.collect())) == [("a", "gol", 1), ("d", "música  clásica", 4)]
    with pytest.raises(ValueError, match="title"):
        labelled_titles(spark.createDataFrame(rows, "category string, titular string"))
    with pytest.raises(ValueError, match="title"):
        require_column(spark.range(1))
    assert preview(spark.range(9)).count() == 5
