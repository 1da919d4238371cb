"""Intermediate tables in the shared folder of the cluster.

A few operators must fix a physical layout (which rows went to which partition) before they use it twice. They write
the laid-out rows as Parquet below ``spark.checkpoint.dir`` and go on from the written table. That cuts the lineage, so
a lost executor costs a re-read and never a second, different layout; and later steps read only the columns they need.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Spark's setting for deleting the shuffle files of a finished write.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table."""
    return f"{_shared_folder(spark).rstrip('/')}/salescope/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    What was shuffled for it is of no more use then; Spark deletes it as soon as the table is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


#: Partitions that shuffles are dealt out over within ``small_tasks``, and the bytes that a task reads of them or of files.
SMALL_TASKS, SMALL_TASK_BYTES = 1024, "16m"


@contextmanager
def small_tasks(spark: SparkSession, size: str | None = None) -> Iterator[None]:
    """Within it, what is run has as many tasks as its bytes need: after a shuffle up to ``SMALL_TASKS``, over files any.
    A task reads ``size``, by default ``SMALL_TASK_BYTES``.

    With the session's number of partitions a task's share grows with the input, and with it the hash tables and sort
    buffers, which are some ten times as large as the compressed rows. Adaptive execution puts small partitions together.
    The same goes for what a task reads from files and has to deal out by key; a file written here is small enough to be
    read by one task.
    """
    size = size or SMALL_TASK_BYTES
    settings = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(
            SMALL_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions"))
        )),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in whatever store it lies."""
    files, place = _file_system(spark, path)
    return files.exists(place)


def file_bytes(df: DataFrame) -> int:
    """The bytes of the files that ``df`` reads, each file once."""
    spark, total = df.sparkSession, 0
    for name in df.inputFiles():
        files, place = _file_system(spark, name)
        total += files.getFileStatus(place).getLen()
    return total


def discard(table: DataFrame) -> None:
    """Delete a table of ``materialise`` that nothing will read again."""
    path = getattr(table, "scratch_path", None)
    if path:
        files, place = _file_system(table.sparkSession, path)
        files.delete(place, True)
