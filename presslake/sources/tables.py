"""Readers of the headline tables the jobs write."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.schemas import FINAL_HEADLINE, FINAL_PARTITIONS, PROCESSED_HEADLINE, SCRAPED_HEADLINE
from presslake.sources.files import dealt, holds, list_files, read_files
from presslake.sources.pages import qualified_root

# Doubled quotes and line breaks inside quoted fields; a quoted empty field is
# an empty string, only an unquoted one is null.
CSV_DIALECT = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "enforceSchema": False,
    "nullValue": "\0",
}


SMALL_BYTES = 4 << 20  # of a file that a task reads whole
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def scan_headline_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = PROCESSED_HEADLINE,
    recursive: bool = False,
) -> DataFrame:
    """Headline CSV files directly under ``path``, or anywhere below it.

    Without a schema the columns are those of the header, all strings; with one
    the header must agree with it. No pass over the data infers anything. Files
    anywhere below may be as many as pages, so tasks list and read those.
    """
    options = {**CSV_DIALECT, "recursiveFileLookup": recursive}
    root = qualified_root(spark, path)
    files = list_files(spark, root) if recursive and holds(root) else None
    if schema is None:
        first = files.select("path").first() if files is not None else None
        names = spark.read.options(**options).csv(_spelled(first.path) if first else path).columns
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    if files is not None:
        return _listed_csv(files, root, schema, CSV_DIALECT, schema.names)
    return spark.read.schema(schema).options(**options).csv(path)


def scan_final_files(spark: SparkSession, path: str) -> DataFrame:
    """The final table by its files below ``path``, without a catalog; tasks list and read them."""
    dialect = {"header": True, "sep": ";", "escape": '"', "multiLine": True}
    root = qualified_root(spark, path)
    if holds(root):
        return _listed_csv(list_files(spark, root), root, FINAL_HEADLINE, dialect, None, FINAL_PARTITIONS)
    columns = [*FINAL_HEADLINE.names, *FINAL_PARTITIONS]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.schema(schema).options(**dialect).csv(path)


def csv_records(text: str, sep: str = ",") -> Iterator[str]:
    """The records of a CSV text as they stand, quotes and the line breaks inside them
    included. What the first line ends with is a line break everywhere; empty lines are
    no records."""
    end = re.search("\r\n|\n|\r|$", text).group()
    if end in ("\r\n", "\r"):
        text = text.replace(end, "\n")
    if '"' not in text:
        yield from filter(None, text.split("\n"))
        return
    field = rf'(?:"[^"]*(?:""[^"]*)*"(?=[{sep}\n]|\Z)|[^{sep}\n]*)'
    record = re.compile(rf"{field}(?:{sep}{field})*")
    at = 0
    while at < len(text):
        own = record.match(text, at).group()
        if own:
            yield own
        at += len(own) + 1


def _spelled(path: str) -> str:
    """A path as Spark's readers take it, where some signs stand for others."""
    return re.sub(r"([\[\]{}*?,\\])", r"\\\1", path)


def _listed_csv(
    files: DataFrame,
    root: str,
    schema: T.StructType,
    dialect: dict,
    header: Sequence[str] | None,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """Listed CSV files: small ones are read whole by tasks, Spark's reader streams the
    others, which are few for their bytes."""
    small = _small_csv(files.filter(F.col("n_bytes") <= SMALL_BYTES), root, schema, dialect, header, partitions)
    large = [_spelled(row.path) for row in files.filter(F.col("n_bytes") > SMALL_BYTES).select("path").collect()]
    if not large:
        return small
    fields = [*schema, *[T.StructField(name, T.StringType()) for name in partitions]]
    reader = files.sparkSession.read.schema(T.StructType(fields)).options(**dialect)
    if partitions:
        return small.unionByName(reader.option("basePath", root).csv(large))
    return small.unionByName(reader.option("recursiveFileLookup", True).csv(large))


def _small_csv(
    files: DataFrame,
    root: str,
    schema: T.StructType,
    dialect: dict,
    header: Sequence[str] | None,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """Listed CSV files below ``root`` that open with a header, each read whole by a task
    and cut into records, which Spark parses. ``header`` is what they must open with;
    ``partitions`` are columns named by the folders."""
    sep = dialect.get("sep", ",")
    wanted = None if header is None else [name.lower() for name in header]

    def values(path: str) -> list[str | None]:
        named = dict(part.split("=", 1) for part in path.split("/")[:-1] if "=" in part)
        own = [named.get(name) for name in partitions]
        return [None if value in (None, NO_VALUE) else unquote(value) for value in own]

    def records(batches):
        for batch in batches:
            paths, at = batch.column(0).to_pylist(), 0
            for some in read_files(root, [batch.column(0)]):
                lines, places = [], []
                for path, data in zip(paths[at:], some.to_pylist()):
                    own = csv_records(data.decode("utf-8-sig", "replace"), sep)
                    names = next(csv.reader([next(own, "")], delimiter=sep), [])
                    if wanted is not None and [name.lower() for name in names] != wanted:
                        raise ValueError(f"CSV header {names} of {path} does not conform to {header}")
                    before = len(lines)
                    lines.extend(own)
                    if partitions:
                        places.extend([values(path)] * (len(lines) - before))
                at += len(some)
                columns = [pa.array([place[i] for place in places], pa.string()) for i in range(len(partitions))]
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), *columns], ["record", *partitions])

    rows = dealt(files).select("path").mapInArrow(
        records, T.StructType([T.StructField(name, T.StringType()) for name in ("record", *partitions)])
    )
    options = {name: str(value) for name, value in dialect.items()} | {"lineSep": "\n"}
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    return rows.select(F.inline(F.array(F.from_csv("record", fields, options))), *partitions)


def scan_scraped_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Scraped headlines: JSON lines, or whole-file JSON arrays."""
    return spark.read.schema(SCRAPED_HEADLINE).option("multiLine", multi_line).json(path)


def scan_landed(spark: SparkSession, path: str) -> DataFrame:
    """Pages landed as a table: source, date, key, html."""
    schema = "key string, html string, source string, date string"
    return spark.read.schema(schema).parquet(path)


def scan_final(spark: SparkSession, table: str, **partition: str | Column) -> DataFrame:
    """The catalogued headline table; partition values prune the files read."""
    unknown = set(partition) - set(FINAL_PARTITIONS)
    if unknown:
        raise ValueError(f"not partition columns: {sorted(unknown)}")
    headlines = spark.table(table)
    for name, value in partition.items():
        headlines = headlines.filter(F.col(name) == value)
    return headlines
