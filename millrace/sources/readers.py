"""Batch scans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.workspace import new_name


def from_rows(spark: SparkSession, rows: Iterable[Any],
              schema: T.StructType | Sequence[str] | str | None = None) -> DataFrame:
    """DataFrame from lists, tuples, dicts or ``Row`` objects.

    No schema gives the default names, a list gives names only, and a
    ``StructType`` is verified against every value before anything runs.
    """
    rows = list(rows)
    return spark.createDataFrame(rows) if schema is None else spark.createDataFrame(rows, schema)


def from_pandas(spark: SparkSession, frame, schema: T.StructType | None = None) -> DataFrame:
    """DataFrame from a pandas frame, transferred as Arrow batches when enabled."""
    return spark.createDataFrame(frame, schema=schema)


def reader(spark: SparkSession, fmt: str, schema: T.StructType | str | None = None,
           **options: Any) -> DataFrameReader:
    """A configured reader that can ``load`` any number of paths."""
    built = spark.read.format(fmt).options(**options)
    return built.schema(schema) if schema is not None else built


def csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
        header: bool = False, infer: bool = False, **dialect: Any) -> DataFrame:
    """CSV scan. Declared schemas avoid the extra pass that inference costs."""
    if schema is not None and infer:
        raise ValueError("declare a schema or infer one, not both")
    if str(dialect.get("encoding", "")).lower() == "utf8":
        dialect["encoding"] = "UTF-8"  # Spark 4 knows charsets by their full name only
    options = {"header": header, "inferSchema": infer, **dialect}
    return reader(spark, "csv", schema, **options).load(path)


def json(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
         multi_line: bool = False, **options: Any) -> DataFrame:
    """JSON scan; ``multi_line`` reads one document per file and cannot split it."""
    return reader(spark, "json", schema, multiLine=multi_line, **options).load(path)


def parquet(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None,
            **options: Any) -> DataFrame:
    """Parquet scan with partition discovery."""
    return reader(spark, "parquet", schema, **options).load(list(paths))


def xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None,
        **options: Any) -> DataFrame:
    """XML scan, one row per ``row_tag`` element."""
    return reader(spark, "xml", schema, rowTag=row_tag, **options).load(path)


def named_view(df: DataFrame, name: str | None = None) -> str:
    """Register ``df`` for SQL and return the name it is known by."""
    name = name or new_name("view")
    df.createOrReplaceTempView(name)
    return name


def sql_on_file(spark: SparkSession, fmt: str, path: str, columns: Sequence[str] = ("*",),
                where: str | None = None) -> DataFrame:
    """Query a file straight from SQL; the path stands where a table name would."""
    if "`" in path:
        raise ValueError("the path may not contain a backtick")
    condition = f" WHERE {where}" if where else ""
    return spark.sql(f"SELECT {', '.join(columns)} FROM {fmt}.`{path}`{condition}")


def view_on_file(spark: SparkSession, fmt: str, path: str, options: Mapping[str, Any],
                 name: str | None = None) -> str:
    """Temporary view over a file, for formats that need reader options in SQL."""
    name = name or new_name("file_view")
    pairs = {"path": path, **options}
    quoted = ", ".join(f"'{key}' '" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
                       for key, value in pairs.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING {fmt} OPTIONS ({quoted})")
    return name


def catalog_overview(spark: SparkSession) -> DataFrame:
    """Tables and views of the current database."""
    return spark.sql("SHOW TABLES").withColumn("currentDatabase", F.lit(spark.catalog.currentDatabase()))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file with its length, whatever its name.

    Like every scan, the listing leaves out names that start with ``_`` or ``.``.
    It runs on Spark and no content is read.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(path).select(F.col("path"), F.col("length")))


def file_of_row() -> Column:
    """Path of the file that a scanned row comes from, spelled as ``file_sizes`` spells it."""
    # the scan gives a URI, in which other characters are escaped but a plus is itself
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders that a finished write has marked, from one flat listing; none where there is no folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return [s.getPath().getName() for s in files.listStatus(root)
            if s.isDirectory() and files.exists(marker(s.getPath(), "_SUCCESS"))]
