"""A stream of page files in the order of their writing, rewritten ones included.

Spark's own file stream takes a path once. Here the offset is the time and path
of the last file taken in, so a file that is written again has a later time and
is read again. Files younger than ``settle`` seconds wait for a later batch:
what is taken in is past, and no file with an earlier time can still appear. A
batch takes in all that has settled, in shares of bounded size: the reader is
not told where the last batch of an earlier run has ended, so it cannot stop on
the way.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from presslake.functions.keys import RAW_PREFIX
from presslake.operators.extract import PERMISSIVE
from presslake.schemas import BINARY_FILE
from presslake.sources.files import open_store

FORMAT = "presslake_pages"
SETTLE_SECONDS = 5.0
PARTITION_BYTES = 1 << 25
PARTITION_FILES = 2_000


class SomeFiles(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class PageFileReader(DataSourceStreamReader):
    """Offsets are (nanoseconds, path below the folder); a batch is what lies between two."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.suffix = options.get("suffix", ".html")
        self.settle = float(options.get("settle", SETTLE_SECONDS))

    def files(self, after: tuple[int, str]) -> list[tuple[int, str, int]]:
        """Files written after an offset and settled, in order: time, path and size."""
        from pyarrow import fs

        store, base = open_store(self.root)
        until = time.time_ns() - int(self.settle * 1e9)
        found = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        names = [
            (info.mtime_ns, info.path[len(base) :].lstrip("/"), info.size)
            for info in found
            if info.is_file and info.path.endswith(self.suffix) and info.size
        ]
        return sorted(f for f in names if after < f[:2] and f[0] <= until)

    def initialOffset(self) -> dict:
        return {"time": 0, "path": ""}

    def latestOffset(self) -> dict:
        """The last file that has settled."""
        at, path, _ = max(self.files((0, "")), default=(0, "", 0))
        return {"time": at, "path": path}

    def partitions(self, start: dict, end: dict) -> list[SomeFiles]:
        """The files between two offsets in shares of bounded size. A file written
        again meanwhile has left this range and comes with a later batch."""
        first, last = (start["time"], start["path"]), (end["time"], end["path"])
        shares: list[list[str]] = [[]]
        size = 0
        for at, path, n in self.files(first):
            if (at, path) > last:
                break
            if shares[-1] and (size + n > PARTITION_BYTES or len(shares[-1]) == PARTITION_FILES):
                shares.append([])
                size = 0
            shares[-1].append(path)
            size += n
        return [SomeFiles(paths) for paths in shares if paths]

    def read(self, partition: SomeFiles) -> Iterator[tuple]:
        store, base = open_store(self.root)
        for path in partition.paths:
            try:
                info = store.get_file_info(f"{base}/{path}")
                with store.open_input_stream(f"{base}/{path}") as stream:
                    data = stream.read()
            except FileNotFoundError:
                continue  # removed since it was listed
            yield f"{self.root}/{path}", info.mtime, len(data), data

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class PageFiles(DataSource):
    """Options: ``path``, the folder; ``suffix`` of the files; ``settle``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return BINARY_FILE

    def streamReader(self, schema) -> PageFileReader:
        return PageFileReader({name.lower(): value for name, value in self.options.items()})


def stream_page_versions(
    spark: SparkSession,
    root: str,
    prefix: str = RAW_PREFIX,
    mode: str = PERMISSIVE,
    settle: float = SETTLE_SECONDS,
) -> DataFrame:
    """Page files as they are written below ``prefix`` of ``root``, again and again.

    Empty files are no pages. Every batch lists the folder once.
    """
    from presslake.sources.pages import decode_pages, qualified_root

    spark.dataSource.register(PageFiles)
    root = qualified_root(spark, root)
    files = (
        spark.readStream.format(FORMAT)
        .option("settle", settle)
        .load(f"{root}/{prefix.strip('/')}")
    )
    return decode_pages(files.select("path", "content"), root, mode)
