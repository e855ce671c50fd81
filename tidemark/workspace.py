"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

An operator that reads the same derived frame twice pins it here first: the
frame is computed once, is stored as Parquet (so that both readers still prune
columns), and outlives lost executors.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_scope: ContextVar[str] = ContextVar("scope", default="session")


def root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder.

    The setting is taken as the cluster gives it. A folder that was only set on
    the context must not be one of this machine alone.
    """
    context = spark.sparkContext
    local = context.master.startswith("local")
    base = spark.conf.get(SETTING, None)
    if not base:
        base = context.getCheckpointDir()
        if base and not local and base.startswith("file:"):
            raise RuntimeError(f"{base} is on this machine alone; set {SETTING} to a shared folder")
    if not base:
        if not local:
            raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/tidemark/{context.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{root(spark)}/{_scope.get()}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written table."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    pinned = df.sparkSession.read.schema(df.schema).parquet(path)
    pinned._pinned_at = path
    return pinned


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over.

    It does so once the driver's references to them are collected, which a driver
    with a large heap may not get to while a long query fills the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unpin(*frames: DataFrame) -> None:
    """Delete pinned tables that no frame will read again, and shuffle files that nothing needs."""
    for df in frames:
        _delete(df.sparkSession, df._pinned_at)
    tidy(frames[0].sparkSession)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scoped(spark: SparkSession) -> Iterator[None]:
    """Delete at exit what is pinned inside. Write results out before that."""
    name = uuid.uuid4().hex
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)
        _delete(spark, f"{root(spark)}/{name}")


def release(spark: SparkSession) -> None:
    """Delete all of this application's pinned tables; frames on them end here."""
    _delete(spark, root(spark))
