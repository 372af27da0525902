"""Staged tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}

#: Paths given out in the open scopes, the innermost last.
_SCOPES: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master, where driver and executors are one process, may go
    without the setting and gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before.

    All paths of one application lie in one folder, which can go when the
    application has ended.
    """
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses; nothing happens where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, everything that operators staged in it.

    Frames made in the block read staged tables, so their results must have been
    written or collected by then.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def new_name(label: str) -> str:
    """A catalog name that nothing has used before."""
    return f"{label}_{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage and survives the loss of executors, unlike a cache, and tells
    Spark the true size of the data.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
