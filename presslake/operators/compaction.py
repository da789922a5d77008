"""Page files of the final table gathered into few large ones.

Every page has a small file of its own below the table's folder, which is the
truth: publishing a page again replaces its file. A partition is read from there
or from a generation: the same rows in files of bounded size, in a folder named
by a digest of the page files it was made from. Which of the two is the
partition's place in the catalog, so a reader lists old files or new ones, never
both, and an unchanged partition is not written again.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.functions.keys import FINAL_PREFIX
from presslake.operators.catalog import place_partitions, partition_places
from presslake.schemas import FINAL_PARTITIONS
from presslake.session import materialize
from presslake.sinks.tables import store_objects
from presslake.sources.page_stream import open_store
from presslake.sources.pages import qualified_root

GENERATIONS = "headlines/generations"
TARGET_BYTES = 1 << 27
LEAST_FILES = 2  # page files of a partition from which it is compacted


def partition_folder(values: Sequence[str]) -> str:
    return FINAL_PREFIX + "".join(f"{name}={value}/" for name, value in zip(FINAL_PARTITIONS, values))


_FILE = "folder string, name string, size bigint, time bigint"


def page_files(spark: SparkSession, root: str, folders: DataFrame) -> DataFrame:
    """(``folder``, ``name``, ``size``, ``time``) of the files of each ``folder`` below
    ``root``. Tasks list the folders; one that is not there has no files."""
    target = qualified_root(spark, root)

    def listed(batches):
        from pyarrow import fs

        store, base = open_store(target)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = store.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True))
                files = [f for f in found if f.is_file and not f.base_name.startswith((".", "_"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([folder] * len(files), pa.string()), pa.array([f.base_name for f in files], pa.string()),
                        pa.array([f.size for f in files], pa.int64()), pa.array([f.mtime_ns for f in files], pa.int64()),
                    ],
                    ["folder", "name", "size", "time"],
                )

    return folders.select("folder").mapInArrow(listed, _FILE)


def digests(files: DataFrame) -> DataFrame:
    """(``folder``, ``digest``, ``n_files``): which files a folder holds, as they are now."""
    mark = F.xxhash64("name", "size", "time")
    return files.groupBy("folder").agg(
        F.concat(F.lower(F.hex(F.bit_xor(mark))), F.lit("-"), F.lower(F.hex(F.bit_xor(F.xxhash64(F.lit(1), mark))))).alias("digest"),
        F.count("*").cast("int").alias("n_files"),
    )


def packed_files(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``files`` with the number ``bin`` of the large file each goes to: a folder's files
    in the order of their names, cut where a multiple of ``target_bytes`` is
    passed, so that a bin exceeds them by a part of one file at most."""
    before = Window.partitionBy("folder").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    cut = files.withColumn("bin", F.floor(start / target_bytes))
    # A file larger than the rest of its bin leaves numbers out.
    number = F.dense_rank().over(Window.partitionBy("folder").orderBy("bin")) - 1
    return cut.select("folder", "name", "size", number.alias("bin"))


def gathered_objects(spark: SparkSession, root: str, bins: DataFrame) -> DataFrame:
    """The large files' ``key`` and ``body``: page files of one bin, one after another
    under one header. A bin is one row, so one task reads and writes it."""
    target = qualified_root(spark, root)

    def run(batches):
        store, base = open_store(target)
        for batch in batches:
            for row in batch.to_pylist():
                parts = []
                for name in sorted(row["names"]):
                    with store.open_input_stream(f"{base}/{row['folder']}{name}") as stream:
                        header, _, body = stream.read().decode("utf-8").partition("\n")
                    parts.append(body if body.endswith("\n") or not body else body + "\n")
                key = f"{row['place']}part-{row['bin']:05d}.csv"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key]), pa.array([header + "\n" + "".join(parts)])], ["key", "body"]
                )

    named = bins.groupBy("folder", "place", "bin").agg(F.collect_list("name").alias("names"))
    return named.mapInArrow(run, "key string, body string")


def compact_final(
    spark: SparkSession,
    root: str,
    table: str,
    partitions: Sequence[Sequence[str]] | None = None,
    target_bytes: int = TARGET_BYTES,
    least_files: int = LEAST_FILES,
) -> DataFrame:
    """Gather the page files of the table's partitions (or of some) and let the catalog
    point to the results; returns a row per partition that was: ``folder``,
    ``n_files`` and ``n_large``.

    Page files stay. Generations that no partition points to any more may be
    removed once no reader that began before can be reading them. A run that
    fails leaves the catalog as it was or some partitions compacted; a rerun
    does the rest. A page published meanwhile is not lost: its partition points to
    the page files again.
    """
    known = partition_places(spark, table, partitions)
    base = qualified_root(spark, root)
    if not known:
        return spark.createDataFrame([], "folder string, n_files int, n_large int")
    values_of = {partition_folder(v): v for v in known}

    def listed(some: Sequence[str]) -> DataFrame:
        folders = spark.createDataFrame([(folder,) for folder in some], "folder string")
        tasks = max(1, min(len(some), spark.sparkContext.defaultParallelism))
        return page_files(spark, root, folders.repartition(tasks, "folder"))

    files = materialize(listed(list(values_of)), "page_files")
    inside = F.substring(F.col("folder"), len(FINAL_PREFIX) + 1, 1 << 30)
    marked = digests(files).filter(F.col("n_files") >= least_files)
    place = F.concat(F.lit(f"{GENERATIONS}/"), inside, F.lit(f"{target_bytes}-"), "digest", F.lit("/"))
    found = marked.select("folder", place.alias("place"), "digest", "n_files").collect()  # a row per partition
    new = {r.folder: r for r in found if known[values_of[r.folder]].rstrip("/") != f"{base}/{r.place}".rstrip("/")}
    if not new:
        return spark.createDataFrame([], "folder string, n_files int, n_large int")
    some = spark.createDataFrame([(f, r.place) for f, r in new.items()], "folder string, place string")
    bins = materialize(packed_files(files.join(F.broadcast(some), "folder"), target_bytes).join(F.broadcast(some), "folder"), "bins")
    store_objects(gathered_objects(spark, root, bins), root)
    place_partitions(spark, table, {values_of[f]: f"{base}/{r.place}" for f, r in new.items()})
    # A page published since the files were listed is in its folder: back to that. One
    # published from now on points its partition there by itself.
    now = {r.folder: r.digest for r in digests(listed(list(new))).collect()}
    changed = [f for f, r in new.items() if now.get(f) != r.digest]
    if changed:
        place_partitions(spark, table, {values_of[f]: f"{base}/{f}" for f in changed})
    done = bins.groupBy("folder").agg(F.count("*").cast("int").alias("n_files"), (F.max("bin") + 1).alias("n_large"))
    return done.filter(~F.col("folder").isin(changed)) if changed else done
