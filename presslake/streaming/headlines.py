"""The same extraction over pages as they arrive.

Each file is read alone, and its rows are written to a file of their own whose
key follows from the page's. So a batch that is run again, or a batch job over
the same pages, writes the same files. The state, in RocksDB, has the paths taken
in, and the greatest key of each source and day where their pages share a file.
A page is taken in once per path, or with ``rewritten`` whenever it is written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from presslake.functions.keys import final_key
from presslake.operators.collisions import KEEP_ALL, LAST
from presslake.operators.extract import PERMISSIVE
from presslake.operators.rules import BLOCK_CARDS, DAILY_SOURCES, RuleSet
from presslake.plans.headlines import final_objects, headline_bodies, partitioned_files, processed_objects
from presslake.session import materialize
from presslake.sinks.tables import store_objects
from presslake.sources.page_stream import stream_page_versions
from presslake.sources.pages import stream_pages
from presslake.streaming.last_writer import last_writer_stream, state_in_rocksdb


def _pages(spark: SparkSession, root: str, rewritten: bool, mode: str, options: Mapping) -> DataFrame:
    return (stream_page_versions if rewritten else stream_pages)(spark, root, mode=mode, **options)


def _start(
    pages: DataFrame, write: Callable[[DataFrame], None], checkpoint: str, once: bool
) -> StreamingQuery:
    writer = (
        pages.writeStream.foreachBatch(lambda batch, number: write(batch))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_processed(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    rules: RuleSet = BLOCK_CARDS,
    once: bool = False,
    mode: str = PERMISSIVE,
    rewritten: bool = False,
    **source_options,
) -> StreamingQuery:
    """Arriving pages to processed CSV; ``once`` stops when all files are in. With
    ``rewritten`` a page that is written again is read again."""
    pages = _pages(spark, root, rewritten, mode, source_options)

    def write(batch: DataFrame) -> None:
        store_objects(processed_objects(batch, rules, mode), root)

    with state_in_rocksdb(spark):
        return _start(pages, write, checkpoint, once)


def stream_final(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    rules: Mapping[str, RuleSet] = DAILY_SOURCES,
    as_of=None,
    once: bool = False,
    mode: str = PERMISSIVE,
    on_collision: str = KEEP_ALL,
    rewritten: bool = False,
    **source_options,
) -> StreamingQuery:
    """Arriving pages to the final table's partitions, every page's rows kept.

    With ``on_collision="last"`` the pages of a source and day share one file, which
    the greatest key fills, as in batch: a lesser key that arrives later changes
    nothing, also after a restart from ``checkpoint``. With ``rewritten`` a page
    that is written again is read again, and its new rows replace the old.
    """
    if on_collision not in (KEEP_ALL, LAST):
        raise ValueError(f"on_collision is {KEEP_ALL!r} or {LAST!r}, not {on_collision!r}")
    pages = _pages(spark, root, rewritten, mode, source_options)
    if on_collision == LAST:
        bodies = headline_bodies(partitioned_files(pages, rules, mode), as_of)
        objects = bodies.select(final_key(F.col("key"), as_of).alias("final_key"), "key", "body")

        def write_last(batch: DataFrame) -> None:
            store_objects(batch.select(F.col("final_key").alias("key"), "body"), root)

        with state_in_rocksdb(spark):
            return _start(last_writer_stream(objects), write_last, checkpoint, once)

    def write(batch: DataFrame) -> None:
        files = materialize(partitioned_files(batch, rules, mode), "parsed")
        store_objects(final_objects(files, as_of), root)

    with state_in_rocksdb(spark):
        return _start(pages, write, checkpoint, once)
