import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

# Names that operators use for columns of their own.
CLASHING = ("score", "shard", "size", "row", "host", "verdict", "group", "text_key", "node", "token", "rate", "_text", "id", "kept", "n")

WORDS = "amber birch cedar dune ember fjord grove heath islet juniper knoll larch moss nettle osier pine quartz reed slate thyme".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7919 + i * i * 31 + i * seed) % len(WORDS)] + str((seed * 13 + i) % 97) for i in range(n))


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Nulls, empty and long texts, repeated rows and ids, and clashing column names."""
    long_text = prose(1, 30_000)
    rows = [
        (1, prose(1, 60), "en", "a"),
        (2, prose(1, 60), "en", "a"),
        (3, None, "en", "a"),
        (4, "", None, None),
        (5, " \n\t ", "fr", "b"),
        (None, prose(2, 80), "fr", None),
        (None, None, None, None),
        (7, long_text, "de", "b"),
        (8, long_text + " more", "de", "b"),
        (9, "word", "de", "b"),
        (10, prose(3, 70), "en", "a"),
        (10, prose(3, 70), "en", "a"),
        (11, "ÉÜ 漢字 😀 <|endoftext|> don't", "en", "a"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return frame.withColumns({name: F.lit("own") for name in CLASHING})
