"""Staged tables that go when they have been used."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from millrace.workspace import new_path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder through the file system that Spark uses."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` once in the shared folder and read it back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def staging(spark: SparkSession):
    """Gives a function like ``stage`` whose tables are removed at the end of the block."""
    paths: list[str] = []

    def put(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
        staged, path = stage(df, label, partition_by)
        paths.append(path)
        return staged
    try:
        yield put
    finally:
        for path in paths:
            remove(spark, path)
