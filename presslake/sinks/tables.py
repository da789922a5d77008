"""Writers. Reruns replace what they wrote before; hot partitions are split."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from presslake.schemas import FINAL_HEADLINE, FINAL_PARTITIONS, PROCESSED_HEADLINE, SCRAPED_HEADLINE
from presslake.session import is_local, is_shared, materialize
from presslake.sources.pages import qualified_root

# Minimal quoting with doubled quotes; text is written as it is.
CSV_DIALECT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
FINAL_DIALECT = {**CSV_DIALECT, "sep": ";"}
# Multi-line CSV files cannot be split on read, so keep them moderate.
ROWS_PER_FILE = 1_000_000
OBJECT_STORES = ("s3", "gcs", "abfs")  # they have no folders to make


def _gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition together (any rows, if no columns are named), but in
    as many tasks as they need: rebalancing splits large shares, joins small ones."""
    return df.hint("rebalance", *columns)


def write_final(headlines: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """The final table: ``;`` CSV under periodico/year/month/day folders.

    Only the partitions present in ``headlines`` are replaced.
    """
    columns = [*FINAL_HEADLINE.names, *FINAL_PARTITIONS]
    (
        _gathered(headlines.select(columns), *FINAL_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .options(**FINAL_DIALECT)
        .partitionBy(*FINAL_PARTITIONS)
        .csv(path)
    )


def write_processed(headlines: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Processed headlines: ``,`` CSV files directly under ``path``."""
    (
        _gathered(headlines.select(PROCESSED_HEADLINE.names))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .options(**CSV_DIALECT)
        .csv(path)
    )


def write_scraped(headlines: DataFrame, path: str) -> None:
    """Scraped headlines as JSON lines; without any nothing is written."""
    scraped = headlines.select(SCRAPED_HEADLINE.names)
    if not scraped.isEmpty():
        scraped.write.mode("overwrite").json(path)


def write_report(lines: DataFrame, path: str, job_name: str) -> str:
    """Report lines, a few per class, as one text file; returns its folder."""
    target = f"{path.rstrip('/')}/classification_report_{job_name}.txt"
    ordered = lines.coalesce(1).sortWithinPartitions("line_no").select("line")
    ordered.write.mode("overwrite").text(target)
    return target


def land_pages(pages: DataFrame, path: str, gather: bool = True) -> None:
    """Pages as a table by source and date; a rerun replaces that source's day.

    Gathering shuffles the pages, for few large files. Without it every task
    writes what it holds, which is as good when a run has few sources and days.
    """
    rows = pages.select("key", "html", "source", "date")
    (
        (_gathered(rows, "source", "date") if gather else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "date")
        .parquet(path)
    )


def csv_body(rows: Column, names: Sequence[str], dialect: Mapping) -> Column:
    """An array of structs as the text of a CSV file with a header."""
    options = {name: str(value).lower() for name, value in dialect.items() if name != "header"}
    lines = F.transform(rows, lambda row: F.to_csv(row, options))
    header = dialect.get("sep", ",").join(names)
    return F.concat(F.lit(header + "\n"), F.array_join(lines, "\n"), F.lit("\n"))


def write_objects(objects: DataFrame, root: str, body: str = "body") -> DataFrame:
    """Write the text of each row as its own object, at its ``key`` below ``root``.

    Tasks write directly, each object whole; a retried task, or a rerun, writes
    the same objects again and no others. The objects are written when the
    result is, a row each with the other columns, ``n_bytes`` and ``error``,
    which tells of a failed one.
    """
    target = qualified_root(objects.sparkSession, root).replace("s3a://", "s3://")
    spark = objects.sparkSession
    if target.startswith("file:") and not is_local(spark) and not is_shared(spark, target):
        raise ValueError(f"{target} is a folder of each machine; objects must go to a shared store")
    kept = [name for name in objects.columns if name != body]
    fields = [objects.schema[name] for name in kept]
    schema = StructType([*fields, StructField("n_bytes", LongType()), StructField("error", StringType())])

    def put(store, folders: set[str], path: str, data: bytes) -> str | None:
        folder = path.rsplit("/", 1)[0]
        try:
            if folder not in folders and store.type_name not in OBJECT_STORES:
                store.create_dir(folder, recursive=True)
                folders.add(folder)
            with store.open_output_stream(path) as stream:
                stream.write(data)
        except OSError as error:
            return str(error)
        return None

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", target))
        folders: set[str] = set()
        for batch in batches:
            keys = batch.column("key").to_pylist()
            bodies = [text.encode("utf-8") for text in batch.column(body).to_pylist()]
            errors = [put(store, folders, f"{base}/{key}", data) for key, data in zip(keys, bodies)]
            sizes = pa.array([len(data) for data in bodies], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], sizes, pa.array(errors, pa.string())],
                [*kept, "n_bytes", "error"],
            )

    return objects.mapInArrow(write, schema)


def write_page_files(pages: DataFrame, root: str) -> DataFrame:
    """Write each page (``source``, ``key``, ``html``) as its own object."""
    return write_objects(pages.select("source", "key", "html"), root, "html")


def store_objects(objects: DataFrame, root: str) -> None:
    """Write objects now; one that could not be written is an error."""
    written = materialize(write_objects(objects, root), "written")
    failed = written.filter(F.col("error").isNotNull()).select("key", "error").head(3)
    if failed:
        raise OSError(f"objects not written: {[tuple(row) for row in failed]}")
