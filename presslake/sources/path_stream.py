"""A stream of the paths below a folder.

The offset is a fingerprint of the paths that are there, so it changes when one
is added; the driver walks through them and holds none. A batch lists the
folders in tasks, all paths of them, and the state of the query is to let pass
those that it has not seen: of a batch that is run again, and of paths that
appear while it runs, none is lost or taken in twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from presslake.functions.keys import PAGE_SUFFIX
from presslake.sources.files import BATCH_FILES, find_folders, open_store, walk

FORMAT = "presslake_paths"
SUMS = 1 << 62


class Folder(InputPartition):
    def __init__(self, path: str, below: bool):
        self.path, self.below = path, below


class PathReader(DataSourceStreamReader):
    """Offsets are the number of paths and a sum over them."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.suffix = options.get("suffix", PAGE_SUFFIX)

    def initialOffset(self) -> dict:
        return {"paths": 0, "sum": 0}

    def latestOffset(self) -> dict:
        store, base = open_store(self.root)
        n = total = 0
        for folder, below in find_folders(self.root):
            for path, _ in walk(store, folder, below):
                if path.endswith(self.suffix):
                    name = path.encode("utf-8", "surrogateescape")
                    n, total = n + 1, total + (crc32(name) << 30) + crc32(name[::-1])
        return {"paths": n, "sum": total % SUMS}

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return [Folder(path, below) for path, below in find_folders(self.root)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        store, base = open_store(self.root)
        base, paths = base.rstrip("/"), []
        for path, _ in walk(store, partition.path, partition.below):
            if path.endswith(self.suffix):
                paths.append(self.root + path[len(base) :])
            if len(paths) == BATCH_FILES:
                yield pa.RecordBatch.from_arrays([pa.array(paths)], ["path"])
                paths = []
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths)], ["path"])

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class Paths(DataSource):
    """Options: ``path``, the folder; ``suffix`` of the files."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return "path string"

    def streamReader(self, schema) -> PathReader:
        return PathReader({name.lower(): value for name, value in self.options.items()})


def stream_paths(spark: SparkSession, folder: str) -> DataFrame:
    """The paths of page files below ``folder``, those known already among them."""
    spark.dataSource.register(Paths)
    return spark.readStream.format(FORMAT).load(folder)
