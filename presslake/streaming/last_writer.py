"""The last writer of each final key over a stream: state that outlives restarts.

For every final key the greatest raw key seen so far is kept in the state store,
and nothing else. A page passes if its key is not less than that; of a batch's
pages for one final key the greatest passes alone, so what is written for the
key at any time is what a batch job over all pages so far would have written.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_PASSED = "final_key string, key string, body string"


class GreatestKey(StatefulProcessor):
    """Of rows ``final_key``, ``key``, ``body``: the one whose key is greatest, if none
    before was greater. Of rows with one key the last one read passes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._greatest = handle.getValueState("greatest", "key string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._greatest.get() if self._greatest.exists() else None
        greatest, best = held[0] if held is not None else None, None
        for row in rows:
            if greatest is None or row.key >= greatest:
                greatest, best = row.key, row
        if best is not None:
            self._greatest.update((greatest,))
            yield Row(final_key=key[0], key=best.key, body=best.body)

    def close(self) -> None:
        pass


def last_writer_stream(objects: DataFrame) -> DataFrame:
    """Of a stream of ``final_key``, ``key`` and ``body`` the rows that are to be written.

    Started with ``state_in_rocksdb``, which the state needs.
    """
    return objects.groupBy("final_key").transformWithState(GreatestKey(), _PASSED, "append", "none")


@contextmanager
def state_in_rocksdb(spark: SparkSession):
    """A query started inside keeps its state in RocksDB; other queries are not touched."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)
