"""Intermediate tables in the folder the cluster shares between executors."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Of each thread, as streams call back from threads of their own: the folders staged in each of its open `released` blocks.
_OPEN = threading.local()


def _blocks() -> list[list[str]]:
    if not hasattr(_OPEN, "blocks"):
        _OPEN.blocks = []
    return _OPEN.blocks


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only one process with neither, as in a small test, gets a folder of its own."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="runtrace-"))
    return context._jsc.sc().getCheckpointDir().get()


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, *partition_columns: str) -> DataFrame:
    """Write a table that several later steps read, and continue from the stored copy.

    The copy cuts the lineage, survives lost executors, and keeps column pruning and filter push-down, which a
    plain checkpoint would lose.
    """
    path = new_folder(df.sparkSession, name)
    if _blocks():
        _blocks()[-1].append(path)
    df.write.partitionBy(*partition_columns).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, work: Callable[[], DataFrame], name: str) -> DataFrame:
    """The stored result of some work; what the work staged for itself is removed."""
    path = new_folder(spark, name)
    if _blocks():
        _blocks()[-1].append(path)
    with released(spark):
        found = work()
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python in Arrow batches of about `BATCH_BYTES` inside the block, unless the session has a size of its own.

    A batch of 10,000 texts is held several times: in the JVM's buffers outside its heap, and as read and cut in the worker.
    """
    if spark.conf.get(_BATCH, None) is not None:
        yield
        return
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH)


def keep_batches_small(spark: SparkSession) -> None:
    """The same from now on, for rows that go to Python after the caller has returned; inside a block of `small_batches` nothing changes."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is stored inside the block go when it is stored, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Remove what this thread stages inside the block at its end. What leaves the block has to be stored elsewhere."""
    _blocks().append([])
    try:
        yield
    finally:
        for path in _blocks().pop():
            remove(spark, path)
