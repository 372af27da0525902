"""A table kept as a log of changes: one folder per version, older versions stay readable.

Snapshots beside the log hold the state at some of its versions. A small index has
one row for each; an as-of read opens the latest snapshot that serves it and the
folders of the versions after that, nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.upsert import DELETE, OP, TIME, VERSION, as_of, last_changes, moment, unique_by_key
from millrace.sources.readers import folder_names
from millrace.workspace import materialize, remove


def append_version(df: DataFrame, path: str, version: int, op: str, at: datetime,
                   keys: Sequence[str] = ()) -> None:
    """Add ``df`` as one version. Writing the same version again replaces it, so retries are safe.

    With ``keys``, a key that occurs twice stops the write. Snapshots that hold the
    version already are dropped.
    """
    if keys:
        df = unique_by_key(df, keys)
    for upto in _snapshots(df.sparkSession, path):
        if upto >= version:
            # the index first: a reader never meets an entry without its snapshot
            remove(df.sparkSession, f"{_index(path)}/{_UPTO}={upto}")
            remove(df.sparkSession, f"{_states(path)}/{_UPTO}={upto}")
    (df.withColumn(OP, F.lit(op)).withColumn(TIME, moment(at))
       .write.mode("overwrite").parquet(f"{path.rstrip('/')}/{VERSION}={version}"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log; the version is a partition column, so as-of reads prune folders."""
    return spark.read.parquet(path)


#: Name of a snapshot's last version in the folders of states and index rows.
_UPTO = "upto"


def _states(path: str) -> str:
    return f"{path.rstrip('/')}-states"


def _index(path: str) -> str:
    return f"{path.rstrip('/')}-index"


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the sub-folders ``name=number`` that were written completely, from one flat listing."""
    return sorted(int(f.split("=", 1)[1]) for f in folder_names(spark, folder) if f.startswith(f"{name}="))


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    return _numbers(spark, _index(path), _UPTO)


def _versions(spark: SparkSession, path: str, after: int | None, upto: int | None) -> DataFrame | None:
    """The log's rows of some versions; only their folders are listed and read."""
    chosen = [v for v in _numbers(spark, path, VERSION) if (after is None or v > after) and (upto is None or v <= upto)]
    if not chosen:
        return None
    root = path.rstrip("/")
    return spark.read.option("basePath", root).parquet(*[f"{root}/{VERSION}={v}" for v in chosen])


def _serving(spark: SparkSession, path: str, version: int | None, timestamp: datetime | None) -> int | None:
    """The last snapshot whose every change lies within the version or the time; the index has one row per snapshot."""
    if not _snapshots(spark, path):
        return None
    index = spark.read.parquet(_index(path))
    within = F.col(_UPTO) <= version if version is not None else F.col("last_ts") <= moment(timestamp)
    return index.where(within).agg(F.max(_UPTO)).first()[0]


def read_as_of(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None,
               timestamp: datetime | None = None) -> DataFrame:
    """The state at a version or a time, equal to ``upsert.as_of`` over the whole log.

    Reads one snapshot and the versions after it. The later changes are reduced to the
    last one of each key and stored, so Spark knows their size and, while they are few,
    sends them to the snapshot, which is not shuffled.
    """
    if (version is None) == (timestamp is None):
        raise ValueError("give a version or a timestamp")
    base = _serving(spark, path, version, timestamp)
    suffix = _versions(spark, path, base, version)
    if base is None:
        if suffix is None:
            raise ValueError(f"no version of {path} is that old")
        return as_of(suffix, keys, version=version, timestamp=timestamp)
    state = spark.read.parquet(f"{_states(path)}/{_UPTO}={base}")
    if suffix is None:
        return state
    if timestamp is not None:
        suffix = suffix.where(F.col(TIME) <= moment(timestamp))
    changed = materialize(last_changes(suffix, keys), "later-changes")
    touched = changed.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return state.join(touched, same, "leftanti").unionByName(changed.where(F.col(OP) != DELETE), allowMissingColumns=True)


def write_snapshot(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None) -> None:
    """Store the state at a version, the last one by default, made from the snapshot before it.

    A state counts once its row in the index is complete, so a failed write leaves
    nothing that is read, and writing it again replaces it.
    """
    found = _numbers(spark, path, VERSION)
    version = version if version is not None else found[-1]
    if version not in found:
        raise ValueError(f"the log has no version {version}")
    read_as_of(spark, path, keys, version=version).write.mode("overwrite").parquet(f"{_states(path)}/{_UPTO}={version}")
    before = _serving(spark, path, version, None)
    later = _versions(spark, path, before, version)
    last = later.agg(F.max(TIME).alias("last_ts")) if later is not None else spark.read.parquet(_index(path)).limit(0).select("last_ts")
    if before is not None:
        earlier = spark.read.parquet(_index(path)).where(F.col(_UPTO) == before).select("last_ts")
        last = last.union(earlier).agg(F.max("last_ts").alias("last_ts"))
    materialize(last, "snapshot-index").coalesce(1).write.mode("overwrite").parquet(f"{_index(path)}/{_UPTO}={version}")
