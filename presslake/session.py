"""Session settings the jobs rely on, and the shared folder they write to."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages are large rows: keep the Arrow batches sent to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Rows per task of a table that is read over and over.
LEAST_ROWS, MOST_ROWS = 2_500, 5_000_000


def local_session(cores: int | str = "*", name: str = "presslake") -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    partitions = str(os.cpu_count() if cores == "*" else cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", partitions)
        # Listing many files takes a task per core, not a task per file.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", partitions)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in this process, so that its disk is theirs."""
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``, or
    the one given to ``SparkContext.setCheckpointDir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError(
            "start the session with spark.checkpoint.dir set to a folder all executors share, "
            "or give one to sparkContext.setCheckpointDir"
        )
    return _local_dir(spark.sparkContext.applicationId)


def is_shared(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, as the file system spells it, lies in the folder that the
    session names as shared by all executors."""
    try:
        named = shared_dir(spark)
    except RuntimeError:
        return False
    return _bare(path).startswith(f"{_bare(named)}/")


def _bare(path: str) -> str:
    """A path of this machine without its scheme; one of another file system as it is."""
    bare = re.sub("^file:/*", "/", path)
    return os.path.normpath(bare) if bare.startswith("/") else bare.rstrip("/")


@functools.cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"presslake-{application_id}-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later stages then neither repeat the work nor depend on the executors that
    did it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, row_id: str, n_rows: int) -> DataFrame:
    """Deal rows out evenly by a unique id, for a table read hundreds of times.

    All cores get a share, but none so small that starting its task costs more
    than reading it, nor so large that it does not fit a task.
    """
    spark = df.sparkSession
    cores = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    parts = max(min(cores, ceil(n_rows / LEAST_ROWS)), ceil(n_rows / MOST_ROWS), 1)
    return df.repartition(parts, row_id)
