"""Reuse of intermediate results, and broadcasts that check their size first."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_owners: list[list[str]] = []


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking ``spark.checkpoint.dir`` when it is set.

    A machine-local folder is only ever chosen for a local master; on a cluster a
    missing setting is an error, because executors could not read the files.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="statweave-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder so that several plans read it once computed."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Unlike a checkpoint this keeps column pruning, filter pushdown and sizes for the
    plans that read it. The files outlive a lost executor and go when the session ends, or
    with the enclosing ``freeing_tables``.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    if _owners:
        _owners[-1].append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_table(df: DataFrame) -> None:
    """Remove the files of a table that ``stage_table`` returned; nothing may read it afterwards."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freeing_tables(spark: SparkSession) -> Iterator[None]:
    """Remove on exit the tables that ``stage_table`` wrote inside; results must be written by then."""
    _owners.append([])
    try:
        yield
    finally:
        for folder in _owners.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each query's shuffle files go when it ends: for steps that stage their results, so that none is read again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` on memory and disk while several actions run over it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; counts no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the row count is checked to be small.

    A larger side is returned unhinted: Spark then joins by shuffle, and adaptive
    execution splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df
