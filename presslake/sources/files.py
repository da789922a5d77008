"""Many small files, listed and read by tasks.

Spark's file sources keep every path on the driver several times over, and a
stream of them starts a task for each. Here the driver looks at folders alone:
it goes down until there are ``FOLDERS`` of them, and tasks find the files in
these and below. The paths are stored, dealt out evenly and read by tasks, so
the driver holds some bytes a folder and nothing of a file.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from presslake.session import materialize

FOLDERS = 64  # to look for on the driver
FILES_PER_TASK, BYTES_PER_TASK = 1_000, 64 << 20
BATCH_BYTES, BATCH_FILES = 4 << 20, 1_000


def open_store(root: str):
    """Arrow's file system for ``root``, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", root.replace("s3a://", "s3://")))


def is_hidden(name: str) -> bool:
    """Whether Spark's file sources pass over a file or folder of this name."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _infos(store, folder: str, below: bool = False) -> list:
    from pyarrow import fs

    return store.get_file_info(fs.FileSelector(folder, recursive=below, allow_not_found=True))


def subfolders(store, folder: str) -> list[str]:
    if store.type_name != "local":
        found = [(info.base_name, info.path) for info in _infos(store, folder) if info.type.name == "Directory"]
    elif not os.path.isdir(folder):
        return []
    else:
        with os.scandir(folder) as entries:
            found = [(entry.name, entry.path) for entry in entries if entry.is_dir()]
    return sorted(path for name, path in found if not is_hidden(name))


def find_folders(root: str, wanted: int = FOLDERS) -> list[tuple[str, bool]]:
    """Folders that hold all files below ``root``, and whether what is below them
    counts with them."""
    store, base = open_store(root)
    alone, last = [], [base.rstrip("/")]
    while last and len(alone) + len(last) < wanted:
        below = [folder for parent in last for folder in subfolders(store, parent)]
        alone, last = alone + last, below
    return [(folder, False) for folder in alone] + [(folder, True) for folder in last]


def walk(store, folder: str, below: bool) -> Iterator[tuple[str, int]]:
    """Path and size of the files in ``folder``, as they are found; empty ones have nothing to read."""
    if store.type_name != "local":
        for info in _infos(store, folder, below):
            inside = info.path[len(folder) :].strip("/").split("/")
            if info.is_file and info.size and not any(map(is_hidden, inside)):
                yield info.path, info.size
    elif os.path.isdir(folder):
        with os.scandir(folder) as entries:
            for entry in entries:
                if is_hidden(entry.name):
                    continue
                try:
                    is_folder, size = entry.is_dir(), entry.stat().st_size
                except FileNotFoundError:
                    continue  # removed meanwhile
                if is_folder:
                    yield from walk(store, entry.path, True) if below else ()
                elif size:
                    yield entry.path, size


def is_readable(root: str) -> bool:
    """Whether Arrow has a file system for ``root``."""
    try:
        open_store(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def holds(root: str) -> bool:
    """Whether Arrow finds the folder ``root``."""
    if not is_readable(root):
        return False
    store, base = open_store(root)
    return store.get_file_info(base.rstrip("/")).type.name == "Directory"


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """``path`` and ``n_bytes`` of the files below ``root`` that end in ``suffix``, as
    they are now, in a stored table; no such folder gives no rows. ``root`` is as the
    file system spells it."""

    def listed(batches):
        store, base = open_store(root)
        base = base.rstrip("/")
        for batch in batches:
            for folder, below in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                paths, sizes = [], []
                for path, size in walk(store, folder, below):
                    if path.endswith(suffix):
                        paths.append(root + path[len(base) :])
                        sizes.append(size)
                    if len(paths) == BATCH_FILES:
                        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(sizes)], ["path", "n_bytes"])
                        paths, sizes = [], []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "n_bytes"]
                )

    folders = find_folders(root)
    rows = spark.createDataFrame(folders, "folder string, below boolean")
    tasks = max(min(len(folders), 4 * spark.sparkContext.defaultParallelism), 1)
    return materialize(rows.repartition(tasks).mapInArrow(listed, "path string, n_bytes bigint"), "listed")


def dealt(files: DataFrame) -> DataFrame:
    """A stored list of files in shares of bounded number and size."""
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    shares = max(ceil(n / FILES_PER_TASK), ceil(size / BYTES_PER_TASK))
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(shares, min(cores, n), 1), "path")


def read_files(root: str, paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The bytes of files below ``root``, in arrays of bounded size."""
    store, base = open_store(root)
    base = base.rstrip("/")
    for some in paths:
        data, size = [], 0
        for path in some.to_pylist():
            with store.open_input_stream(base + path[len(root) :]) as stream:
                data.append(stream.read())
            size += len(data[-1])
            if size >= BATCH_BYTES:
                yield pa.array(data, pa.binary())
                data, size = [], 0
        if data:
            yield pa.array(data, pa.binary())


def with_contents(files: DataFrame, root: str) -> DataFrame:
    """Files below ``root`` by ``path``, with their ``content``. As a generator's output
    it is read once, and filters on the path go below the reading."""

    def contents(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return read_files(root, paths)

    read = F.arrow_udf(contents, BinaryType())
    return files.select("path", F.explode_outer(F.array(read("path"))).alias("content"))
