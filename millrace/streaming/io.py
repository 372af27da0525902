"""Stream sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.missing import dedup_by_key
from millrace.sources.readers import file_sizes
from millrace.workspace import materialize, remove

BATCH = "_batch"


def file_stream(spark: SparkSession, fmt: str, path: str, schema: T.StructType | str,
                files_per_batch: int | None = None, **options) -> DataFrame:
    """Files appearing in a folder (or matching a glob) as a stream. The schema must be declared."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _configured(df: DataFrame, mode: str, checkpoint: str | None, every: str | None,
                name: str | None = None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    # Without an interval the query takes what is there, in bounded batches, and stops.
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None,
             partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append to files, each row exactly once."""
    writer = _configured(df, "append", checkpoint, every).format(fmt).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def to_table(df: DataFrame, name: str, checkpoint: str, path: str | None = None,
             every: str | None = None) -> StreamingQuery:
    """Append to a catalog table."""
    writer = _configured(df, "append", checkpoint, every).format("parquet")
    if path:
        writer = writer.option("path", path)
    return writer.toTable(name)


def to_console(df: DataFrame, mode: str = "update", every: str | None = None, rows: int = 20
               ) -> StreamingQuery:
    """Print each batch: for looking at a stream during development."""
    return _configured(df, mode, None, every).format("console").option("numRows", rows).start()


def to_memory(df: DataFrame, name: str, mode: str = "complete", every: str | None = None) -> StreamingQuery:
    """Keep the result as a temporary view on the driver: for small previews only."""
    return _configured(df, mode, None, every, name).format("memory").start()


def to_batches(df: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str, mode: str,
               every: str | None = None) -> StreamingQuery:
    """Hand each batch and its number to a function that writes it."""
    return _configured(df, mode, checkpoint, every).foreachBatch(function).start()


def _write_batch(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        # One folder per batch: a batch that is run again replaces what it wrote before.
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")
    return write


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the stored batches, from the file names, so that batches without rows count."""
    number = F.regexp_extract("path", f"/{BATCH}=([0-9]+)/", 1).cast("long").alias("n")
    return sorted(r.n for r in file_sizes(spark, path).select(number).distinct().collect())


def to_snapshots(df: DataFrame, path: str, checkpoint: str, every: str | None = None, keep: int = 2
                 ) -> StreamingQuery:
    """Complete mode: each batch stores the whole result in a folder of its own; the last ``keep`` stay."""
    write = _write_batch(path)

    def replace(batch: DataFrame, number: int) -> None:
        write(batch, number)
        for old in _batches(batch.sparkSession, path):
            if old <= number - max(1, keep):
                remove(batch.sparkSession, f"{path}/{BATCH}={old}")
    return to_batches(df, replace, checkpoint, "complete", every)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The result as of the last batch, also when it has no rows."""
    return spark.read.parquet(f"{path}/{BATCH}={_batches(spark, path)[-1]}")


def to_update_log(df: DataFrame, path: str, checkpoint: str, every: str | None = None,
                  keys: Sequence[str] = (), fold_every: int = 20) -> StreamingQuery:
    """Update mode: each batch stores only the rows that changed.

    With ``keys``, every ``fold_every`` batches the log is folded into one row per
    key, so its size follows the number of keys. A fold is stored before older
    batches go, and folding again gives the same.
    """
    write = _write_batch(path)

    def store(batch: DataFrame, number: int) -> None:
        if not keys or number % fold_every or not number:
            return write(batch, number)
        spark = batch.sparkSession
        both = spark.read.parquet(path).unionByName(batch.withColumn(BATCH, F.lit(number)))
        folded = materialize(dedup_by_key(both, keys, [F.desc(BATCH)]).drop(BATCH), "folded")
        write(folded, number)
        for old in _batches(spark, path):
            if old < number:
                remove(spark, f"{path}/{BATCH}={old}")
    return to_batches(df, store, checkpoint, "update", every)


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert on read: the row of the latest batch for each key."""
    return dedup_by_key(spark.read.parquet(path), keys, [F.desc(BATCH)]).drop(BATCH)


def progress_frame(query: StreamingQuery) -> DataFrame:
    """The recent progress reports of a query as a table."""
    session = SparkSession.getActiveSession()
    rows = [(str(query.id), str(query.runId), p.batchId, p.numInputRows) for p in query.recentProgress]
    return session.createDataFrame(rows, "id string, run_id string, batch long, input_rows long")


def finish(query: StreamingQuery) -> None:
    """Wait for a query that ends by itself, and pass on its error if it has one."""
    query.awaitTermination()
