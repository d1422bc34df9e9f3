"""Cutting lineage where one intermediate result feeds several jobs.

The data is written to the shared folder named by ``spark.checkpoint.dir``, as
compressed Parquet, and read back, so a lost executor costs a re-read, not a
recomputation of everything upstream, and a reader takes the columns it needs.
The folder is read from the session; nothing here picks a machine-local path.
Without a configured folder the data is persisted instead (recomputable from
lineage).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from catrec.sinks import fs

#: Lets a job's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_dir(df: DataFrame) -> str | None:
    sc = df.sparkSession.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the writes inside go with them: what they wrote is what later jobs read."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and return a DataFrame reading the stored result.

    Record texts repeat much of each other; stored in columns and compressed
    they take a small part of the bytes that a cache or an RDD checkpoint does.
    The shuffle files of the job are dropped with its end.
    """
    folder = checkpoint_dir(df)
    if not folder:
        persisted = df.persist(StorageLevel.MEMORY_AND_DISK)
        persisted.count()
        return persisted
    path = f"{folder.rstrip('/')}/stored-{uuid.uuid4().hex}"
    with shuffle_files_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_path = path
    return kept


def discard(*frames: DataFrame) -> None:
    """Drops what :func:`materialize` kept of frames that no later job reads."""
    for frame in frames:
        path = getattr(frame, "stored_path", None)
        if path:
            fs.delete(frame.sparkSession, *path.rsplit("/", 1))
        else:
            frame.unpersist()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the session's checkpoint folder, for files that a query writes and reads back.

    Where none is set, a session whose tasks all run in this process gets a
    folder of this machine; on a cluster that would scatter the files, so it fails.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="catrec-", dir="/tmp")
    return f"{configured.rstrip('/')}/{name}-{uuid.uuid4().hex}"
