"""Keyed state of a stream as files: each batch rewrites only the buckets of the keys it touches.

Below the path, ``data/_batch=n/_bucket=b`` holds a bucket as batch n left it, and
``index/_batch=n`` which batch last wrote each bucket. A batch counts once its index
is complete; it starts from the index before it, so doing it again gives the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.missing import dedup_by_key
from millrace.sources.readers import folder_names
from millrace.streaming.io import BATCH, to_batches
from millrace.workspace import materialize, remove

BUCKET = "_bucket"


def _done(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.split("=", 1)[1]) for name in folder_names(spark, f"{path}/index"))


def _index(spark: SparkSession, path: str, number: int) -> dict[int, int]:
    """Batch that last wrote each bucket; as many rows as there are buckets at most."""
    return {r.bucket: r.batch for r in spark.read.parquet(f"{path}/index/{BATCH}={number}").collect()}


def _scan(spark: SparkSession, path: str, written: dict[int, int]) -> DataFrame | None:
    folders = [f"{path}/data/{BATCH}={batch}/{BUCKET}={bucket}" for bucket, batch in sorted(written.items())]
    return spark.read.option("basePath", f"{path}/data").parquet(*folders).drop(BATCH) if folders else None


def upsert_batch(batch: DataFrame, number: int, path: str, keys: Sequence[str], buckets: int = 64, keep: int = 2) -> None:
    """Make the rows of ``batch`` the state of their keys; the last ``keep`` batches stay readable.

    Only buckets that hold a key of the batch are read and written. If a key occurs
    twice, one row of it stays.
    """
    spark = batch.sparkSession
    before = [n for n in _done(spark, path) if n < number]
    written = _index(spark, path, before[-1]) if before else {}
    changed = materialize(dedup_by_key(batch, keys, [F.xxhash64(*batch.columns)]).withColumn(
        BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "changed")
    touched = {r[0] for r in changed.select(BUCKET).distinct().collect()}
    old = _scan(spark, path, {b: n for b, n in written.items() if b in touched})
    state = changed
    if old is not None:
        renamed = changed.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        state = old.join(renamed, same, "leftanti").unionByName(changed)
    if touched:
        state.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/data/{BATCH}={number}")
    index = {**written, **{b: number for b in touched}}
    spark.createDataFrame(sorted(index.items()), "bucket int, batch long").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/index/{BATCH}={number}")
    _drop(spark, path, [*before, number], keep)


def _drop(spark: SparkSession, path: str, done: list[int], keep: int) -> None:
    """Remove old indexes, the oldest first, and then the buckets that none of the ``keep`` later ones names."""
    if len(done) <= keep:
        return
    gone, needed = done[0], set()
    for number in done[-keep:]:
        needed |= set(_index(spark, path, number).items())
    old = _index(spark, path, gone)
    remove(spark, f"{path}/index/{BATCH}={gone}")
    for bucket, batch in old.items():
        if (bucket, batch) not in needed:
            remove(spark, f"{path}/data/{BATCH}={batch}/{BUCKET}={bucket}")


def to_keyed_state(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int = 64,
                   every: str | None = None) -> StreamingQuery:
    """Update mode: the latest row of every key, in buckets that are rewritten when one of their keys changes."""
    return to_batches(df, lambda batch, number: upsert_batch(batch, number, path, keys, buckets), checkpoint, "update", every)


def read_keyed_state(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every key as of the last complete batch."""
    done = _done(spark, path)
    if not done:
        raise ValueError(f"no batch below {path} is complete")
    found = _scan(spark, path, _index(spark, path, done[-1]))
    if found is None:
        raise ValueError(f"no batch below {path} had a row")
    return found.drop(BUCKET)
