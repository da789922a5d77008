"""Schemas of the data sets that move between the stages."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_PAGE = _strings("key", "html", "error")

# One row per file, as Spark's binaryFile source yields it.
BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

# Body of an object-created notification.
OBJECT_CREATED = (
    "Records array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
)

FINAL_HEADLINE = _strings("categoria", "titular", "enlace", "fecha_extraccion")
FINAL_PARTITIONS = ("periodico", "year", "month", "day")
PROCESSED_HEADLINE = _strings("category", "title", "description")
SCRAPED_HEADLINE = _strings("category", "title", "link")
