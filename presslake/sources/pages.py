"""Where pages come from: files, a stream of files, or object-created events."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.keys import PAGE_SUFFIX, RAW_PREFIX, decode_key, is_page_key
from presslake.operators.extract import FAILFAST, PERMISSIVE
from presslake.schemas import BINARY_FILE, OBJECT_CREATED, RAW_PAGE
from presslake.sources.files import dealt, is_readable, list_files, with_contents
from presslake.sources.path_stream import stream_paths

PAGE_FILES = f"*{PAGE_SUFFIX}"
MAX_FILES_PER_TRIGGER = 10_000
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
BAD_ENCODING = "not valid UTF-8"
BAD_EVENT = "not an object notification"
BAD_RECORD = "names no object"


def qualified_root(spark: SparkSession, root: str) -> str:
    """``root`` as the file system spells it: with scheme, absolute, no ``..``."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")


def key_below(path: Column, root: str) -> Column:
    """A file's path relative to ``root``, whatever scheme either is given in; a
    path that is not below it is an error."""
    base = F.regexp_replace(F.lit(root.rstrip("/") + "/"), _SCHEME, "")
    bare = F.regexp_replace(path, _SCHEME, "")
    inside = F.substring(bare, F.length(base) + 1, F.length(bare))
    outside = F.raise_error(F.concat(path, F.lit(f" is not below {root}")))
    return F.when(bare.startswith(base), inside).otherwise(outside.cast("string"))


def decode_pages(files: DataFrame, root: str, mode: str = PERMISSIVE) -> DataFrame:
    """Whole files as pages. Bytes that are not UTF-8 give a null page and an
    error; with ``FAILFAST`` they fail the query."""
    text = F.col("content").cast("string")
    html = F.validate_utf8(text) if mode == FAILFAST else F.try_validate_utf8(text)
    pages = files.select(key_below(F.col("path"), root).alias("key"), html.alias("html"))
    return pages.withColumn(
        "error", F.when(F.col("html").isNull(), F.lit(BAD_ENCODING)).cast("string")
    )


def scan_pages(
    spark: SparkSession, root: str, prefix: str = RAW_PREFIX, mode: str = PERMISSIVE
) -> DataFrame:
    """All page files below ``prefix`` of ``root``, as they are now; no such folder gives no pages.

    Tasks list and read them, if Arrow has a file system for ``root``; else Spark's
    file source does, which lists them on the driver.
    """
    root = qualified_root(spark, root)
    if is_readable(root):
        folder = f"{root}/{prefix.strip('/')}"
        files = with_contents(dealt(list_files(spark, folder, PAGE_SUFFIX)), folder)
        return decode_pages(files, root, mode)
    reader = spark.read.format("binaryFile").options(
        recursiveFileLookup=True, pathGlobFilter=PAGE_FILES
    )
    try:
        files = reader.load(f"{root}/{prefix}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW_PAGE)
    return decode_pages(files.select("path", "content"), root, mode)


def stream_pages(
    spark: SparkSession,
    root: str,
    prefix: str = RAW_PREFIX,
    mode: str = PERMISSIVE,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Page files as they arrive below ``prefix`` of ``root``, a path once.

    A batch takes in all that is new, or at most ``max_files_per_trigger`` as Spark's
    own file stream finds them, whose driver holds all paths. Which paths were taken
    in is kept in the query's state, so start it with ``state_in_rocksdb``. Tasks read
    the files; where Arrow has no file system for ``root``, Spark's file stream does.
    """
    root = qualified_root(spark, root)
    folder = f"{root}/{prefix.strip('/')}"
    readable = is_readable(root)
    if max_files_per_trigger is None and readable:
        paths = stream_paths(spark, folder)
    else:
        files = (
            spark.readStream.format("binaryFile")
            .schema(BINARY_FILE)
            .options(
                recursiveFileLookup=True,
                pathGlobFilter=PAGE_FILES,
                maxFilesPerTrigger=max_files_per_trigger or MAX_FILES_PER_TRIGGER,
            )
            .load(folder)
        )
        if not readable:
            return decode_pages(files.select("path", "content"), root, mode)
        paths = files.select("path")
    return decode_pages(with_contents(paths.dropDuplicates(["path"]), folder), root, mode)


def event_objects(events: DataFrame, body: str = "body") -> DataFrame:
    """The objects that JSON object-created notifications tell of, one per row.

    A body that is no notification gives one row, and a record without a bucket
    or key keeps its row, both with an ``error``.
    """
    kept = [F.col(name) for name in events.columns if name != body]
    records = F.from_json(F.col(body), OBJECT_CREATED)["Records"]
    rows = events.select(*kept, records.isNull().alias("bad"), F.explode_outer(records).alias("record"))
    # A notification with an empty list of records names nothing and is no error.
    rows = rows.filter("bad OR record IS NOT NULL")
    bucket, key = F.col("record.s3.bucket.name"), F.col("record.s3.object.key")
    error = F.when(F.col("bad"), BAD_EVENT).when(bucket.isNull() | key.isNull(), BAD_RECORD)
    return rows.select(*kept, bucket.alias("bucket"), decode_key(key).alias("key"), error.alias("error"))


def page_events(events: DataFrame, body: str = "body") -> DataFrame:
    """Of those objects, the page files, and what could not be read."""
    return event_objects(events, body).filter(is_page_key(F.col("key")) | F.col("error").isNotNull())


def pages_of_events(
    events: DataFrame, pages: DataFrame, body: str = "body", bucket: str | None = None
) -> DataFrame:
    """The landed pages that notifications name, each once.

    ``pages`` are of one ``bucket``; notifications of others are not about them.
    Without a name all notifications count. Repeated ones are reduced before the
    join; unreadable ones are in ``page_events``.
    """
    named = page_events(events, body).filter(F.col("error").isNull())
    if bucket is not None:
        named = named.filter(F.col("bucket") == bucket)
    return pages.join(named.select("key").distinct(), "key", "left_semi")


def read_event_pages(
    events: DataFrame, root_of_bucket: str, body: str = "body", mode: str = PERMISSIVE
) -> DataFrame:
    """The pages that notifications name, read object by object: no folder is listed.

    ``root_of_bucket`` holds ``{bucket}`` where the bucket's name goes. Rows have
    ``bucket``, ``key``, ``html`` and ``error``; an object that cannot be read
    has an error, as has a notification that names none. Tasks read the objects,
    so the pages come through no shuffle; only the names do, each once.
    """
    named = page_events(events, body).select("bucket", "key", "error").distinct()

    def read(batches):
        from pyarrow import fs

        stores: dict[str, tuple] = {}
        for batch in batches:
            rows = batch.to_pylist()
            contents, errors = [], []
            for row in rows:
                data, error = None, row["error"]
                if error is None:
                    root = root_of_bucket.replace("{bucket}", row["bucket"]).rstrip("/")
                    try:
                        if root not in stores:
                            stores[root] = fs.FileSystem.from_uri(root.replace("s3a://", "s3://"))
                        store, base = stores[root]
                        with store.open_input_stream(f"{base}/{row['key']}") as stream:
                            data = stream.read()
                    except OSError as failure:
                        error = f"{type(failure).__name__}: {failure}"
                contents.append(data)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), batch.column("key"), pa.array(contents, pa.binary()), pa.array(errors, pa.string())],
                ["bucket", "key", "content", "error"],
            )

    files = named.mapInArrow(read, "bucket string, key string, content binary, error string")
    text = F.col("content").cast("string")
    html = F.validate_utf8(text) if mode == FAILFAST else F.try_validate_utf8(text)
    wrong = F.when(F.col("content").isNotNull() & F.col("html").isNull(), F.lit(BAD_ENCODING))
    pages = files.select("bucket", "key", html.alias("html"), "content", "error")
    return pages.select("bucket", "key", "html", F.coalesce("error", wrong).alias("error"))
