"""A table of Parquet files that a manifest names, so that files can be replaced while others read them.

Below the table's path, ``files/run=<n>`` holds what one write added and
``manifests/version=<n>`` the list of files of one version. A version counts once its
list is complete (its ``_SUCCESS`` marker is there); readers take the highest one or
any earlier one. Files are never changed or deleted here.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.readers import file_of_row, file_sizes, folder_names
from millrace.workspace import materialize

_MANIFEST = "path string, run int, folder string, bytes bigint, schema string, partitions string"


def versions(spark: SparkSession, table: str) -> list[int]:
    """Complete versions, the oldest first."""
    return sorted(int(name.split("=", 1)[1]) for name in folder_names(spark, f"{table}/manifests"))


def manifest(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """Files of a version: path, run, folder of the partition, bytes, and the table's schema."""
    version = version if version is not None else versions(spark, table)[-1]
    return spark.read.schema(_MANIFEST).parquet(f"{table}/manifests/version={version}")


def _commit(spark: SparkSession, table: str, files: DataFrame, version: int) -> None:
    """Make ``files`` a version. Two writers of one version: the second one fails, since the folder is there."""
    materialize(files, "manifest").coalesce(1).write.parquet(f"{table}/manifests/version={version}")


def _added(spark: SparkSession, table: str, run: int, schema: str, partitions: str) -> DataFrame:
    """Manifest rows of the files that a run wrote."""
    root = f"{table}/files/run={run}"
    listed = file_sizes(spark, root).where(F.col("path").endswith(".parquet"))
    inside = F.regexp_extract("path", rf".*/run={run}/(.*?)/?[^/]+$", 1)
    return listed.select("path", F.lit(run).alias("run"), inside.alias("folder"), F.col("length").alias("bytes"),
                         F.lit(schema).alias("schema"), F.lit(partitions).alias("partitions"))


def append(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """Add the rows of ``df`` as the next version of the table, which the first call makes. Returns the version.

    Later calls use the partition columns of the first and must have its schema.
    """
    spark = df.sparkSession
    found = versions(spark, table)
    if found:
        first = manifest(spark, table, found[-1]).select("schema", "partitions").first()
        schema, partitions = first.schema, first.partitions
        if T.StructType.fromJson(json.loads(schema)) != df.schema:
            raise ValueError("the rows have another schema than the table")
    else:
        schema, partitions = df.schema.json(), ",".join(partition_by)
    version = found[-1] + 1 if found else 0
    columns = [c for c in partitions.split(",") if c]
    writer = df.write.mode("overwrite")
    # a run that failed before its version was complete is written over
    (writer.partitionBy(*columns) if columns else writer).parquet(f"{table}/files/run={version}")
    files = _added(spark, table, version, schema, partitions)
    _commit(spark, table, manifest(spark, table, found[-1]).unionByName(files) if found else files, version)
    return version


def _scan(spark: SparkSession, table: str, files: list[str], schema: str) -> DataFrame:
    declared = T.StructType.fromJson(json.loads(schema))
    wide = T.StructType([*declared.fields, T.StructField("run", T.IntegerType())])
    return spark.read.schema(wide).option("basePath", f"{table}/files").parquet(*files)


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the last one by default, with the columns in their first order."""
    listed = manifest(spark, table, version).select("path", "schema").collect()
    return _scan(spark, table, [r.path for r in listed], listed[0].schema).select(
        *[f"`{f['name']}`" for f in json.loads(listed[0].schema)["fields"]])


def _bins(target_bytes: int) -> Column:
    """Number of the bin of a file: small files of a folder in order of size, cut where a bin is full.

    Neighbours in size share a bin, so a bin has at most ``target_bytes`` and one file more.
    """
    before = Window.partitionBy("folder").orderBy("bytes", "path").rowsBetween(Window.unboundedPreceding, -1)
    return F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes).cast("int")


def compact(spark: SparkSession, table: str, target_bytes: int = 256 << 20, small: float = 0.5) -> int | None:
    """Rewrite only files below ``small`` of the target size, a folder at a time; the others stay as they are.

    Small files of a partition go into bins of about ``target_bytes``; a bin of one file
    is left alone. Each bin is one task and one new file: rows are sent to the task whose
    number is that of their file's bin, so what is read, shuffled and written is the small
    files. The new list of files becomes the next version; readers of older ones keep
    theirs. Returns the version, None where nothing is to do.
    """
    found = versions(spark, table)
    listed = manifest(spark, table, found[-1])
    candidates = listed.where(F.col("bytes") < F.lit(small * target_bytes)).withColumn("bin", _bins(target_bytes))
    chosen = materialize(candidates.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))).where("n > 1").select(
        "path", "folder", F.dense_rank().over(Window.orderBy("folder", "bin")).alias("task")), "small-files")
    files = chosen.collect()
    if not files:
        return None
    one = listed.first()
    version, tasks = found[-1] + 1, max(r.task for r in files)
    rows = _scan(spark, table, [r.path for r in files], one.schema)
    # the list of chosen files is as long as the scan's own, which the driver holds anyway
    dealt = (rows.withColumn("_path", file_of_row()).join(
        F.broadcast(chosen.select(F.col("path").alias("_path"), "task")), "_path").drop("_path", "run")
        .repartitionById(tasks, F.col("task") - 1).drop("task"))
    columns = [c for c in one.partitions.split(",") if c]
    writer = dealt.write.mode("overwrite")
    (writer.partitionBy(*columns) if columns else writer).parquet(f"{table}/files/run={version}")
    kept = listed.join(chosen.select("path"), "path", "leftanti")
    _commit(spark, table, kept.unionByName(_added(spark, table, version, one.schema, one.partitions)), version)
    return version
