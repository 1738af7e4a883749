"""Reading inputs and cutting lineage for the llm operators."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.session import scratch_path, ship_package

#: Rows of an Arrow batch at most, and bytes after which a batch ends: batches
#: hold whole texts.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20

#: Ids that may be broadcast (8 MB of longs); a longer list is joined by shuffle.
BROADCAST_IDS = 1_000_000


def prepare_tasks(spark: SparkSession) -> None:
    """Make the package known to Python tasks and keep their batches small."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_recorded: list[list[str]] = []

#: After so many written tables the driver drops what finished jobs left on it.
WRITES_BETWEEN_CLEANING = 4
_writes = count(1)


def clean_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage.  Every stage, file scan and broadcast takes
    a block of 4 MB of the driver's heap, which grows when many short jobs follow
    each other; Spark's cleaner also removes broadcasts and shuffle files of
    finished jobs only after a collection."""
    gc.collect()  # frames in Python hold their plans on the driver
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written copy outlives lost executors, and later branches read it
    instead of computing it again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    for paths in _recorded:
        paths.append(path)
    if next(_writes) % WRITES_BETWEEN_CLEANING == 0:
        clean_driver(spark)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that ``materialize`` writes while the context is open."""
    paths: list[str] = []
    _recorded.append(paths)
    try:
        yield paths
    finally:
        _recorded.pop()


def remove(spark: SparkSession, paths: list[str], still_read: DataFrame | None = None) -> None:
    """Delete folders that ``materialize`` wrote, but for those that
    ``still_read`` has yet to read."""
    needed = still_read.inputFiles() if still_read is not None else []
    for path in paths:
        if not any(path.rsplit("/", 1)[-1] in f for f in needed):
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bounded(df: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as
    it is, so that Spark shuffles the join.  ``df`` must be narrow and cheap
    to count (a written table)."""
    return F.broadcast(df) if df.count() <= rows else df


def drop_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (null ids stay)."""
    gone = ids.select(F.col(column).alias("__gone"))
    return docs.join(bounded(gone), docs[column] == gone["__gone"], "left_anti")
