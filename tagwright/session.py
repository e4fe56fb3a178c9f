"""Helpers that depend on the session: shared folder, size check and input spreading."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.fixed_values import BROADCAST_BYTES


# The folder of the innermost ``temporary`` block.
_TEMPORARY: ContextVar[str | None] = ContextVar("temporary", default=None)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What was sent to the executors in that block.
_SENT: ContextVar[list[Broadcast] | None] = ContextVar("sent", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by spark.checkpoint.dir.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tagwright-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    parent = _TEMPORARY.get() or f"{shared_folder(spark)}/tagwright"
    return f"{parent}/{purpose}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """The file system of ``path`` and its name there."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def delete(spark: SparkSession, path: str) -> None:
    files, name = _folder(spark, path)
    files.delete(name, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, name = _folder(spark, path)
    return files.exists(name)


def subfolders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """The names of the folders in ``path`` and when they were changed, in seconds since 1970."""
    files, name = _folder(spark, path)
    if not files.exists(name):
        return []
    inside = [entry for entry in files.listStatus(name) if entry.isDirectory()]
    return [(entry.getPath().getName(), entry.getModificationTime() / 1000) for entry in inside]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what the block runs go when it has run, instead of when the driver next collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What the block writes to new folders or sends is deleted at its end, so nothing lazy may read it later.

    Shuffle files of what it runs are deleted at once.
    """
    folder, sent = new_folder(spark, "temporary"), []
    outer, outer_sent = _TEMPORARY.set(folder), _SENT.set(sent)
    try:
        with shuffles_dropped(spark):
            yield
    finally:
        _TEMPORARY.reset(outer)
        _SENT.reset(outer_sent)
        for value in sent:
            value.destroy()
        delete(spark, folder)


def send(spark: SparkSession, value) -> Broadcast:
    """``value`` for the Python workers of all executors; in a ``temporary`` block until its end."""
    shared = spark.sparkContext.broadcast(value)
    if _SENT.get() is not None:
        _SENT.get().append(shared)
    return shared


def written(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later jobs do not compute it again.

    In a ``temporary`` block it is written small, and its shuffle files go.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, purpose)
    if _TEMPORARY.get():
        with shuffles_dropped(spark):
            df.write.option("compression", "zstd").parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def given_bytes(df: DataFrame) -> int:
    """What Spark takes for the size of a scan, without running anything."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, row_bytes: Column) -> bool:
    """Whether the rows of ``df``, of ``row_bytes`` each, may be sent to every executor."""
    total = df.agg(F.sum(row_bytes)).first()[0]
    return (total or 0) <= BROADCAST_BYTES


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that has fewer partitions than the cluster has cores.

    A large table is split finely enough by its files and is returned as it is.
    ``df`` must be a scan with narrow steps only, else counting partitions runs its shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, *keys)
