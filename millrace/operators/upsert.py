"""Merges, slowly changing history and as-of reads as DataFrame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import anti_join
from millrace.operators.project import hashable_columns
from millrace.workspace import materialize

VERSION = "_version"
OP = "_op"
TIME = "_ts"
DELETE = "delete"

#: End of validity of an open version (fixed value).
OPEN_END = datetime(2199, 12, 31)


def moment(at: datetime) -> Column:
    """A wall-clock time as a literal, whatever zone the machine or the session is in."""
    return F.lit(at.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def _fail_if(condition: Column, message: str) -> Column:
    """A filter that lets every row pass, or stops the query."""
    return F.when(condition, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def _same(keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(key) == F.col(prefix + key))
    return condition


def unique_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, but the query fails when a key occurs twice.

    NULL keys match nothing and may repeat.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    others = [c for c in df.columns if c not in keys]
    checked = (df.where(known).groupBy(*keys)
               .agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*(others or keys))).alias("_row"))
               .where(_fail_if(F.col("_n") > 1, "several source rows have the same merge key"))
               .select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`") for c in df.columns]))
    return checked.unionByName(df.where(~known))


def _touched(base: DataFrame, staged: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The listed columns of the base rows whose key is in the staged change set.

    Spark knows the size of the stored change set: while it is small it is sent
    to the base, which is then read but not shuffled.
    """
    return base.select(*columns).join(staged.select(*keys).distinct(), list(keys), "leftsemi")


def merge_insert(base: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the base and add source rows whose key it lacks; doing it again changes nothing.

    NULL keys match nothing, so such rows are added each time. The known keys and the
    added rows, neither more than the source, are stored in turn: the joins run in stages
    of their own, and merging into the result again reads rows instead of joining anew.
    """
    staged = materialize(source, "merge-source")
    present = materialize(_touched(base, staged, keys, keys), "merge-present")
    return base.unionByName(materialize(anti_join(staged, present, keys), "merge-added"))


def merge_upsert(base: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace base rows of the same key; the rest of both sides stays.

    The source is stored first, and fails to be if a key occurs in it twice.
    """
    staged = materialize(unique_by_key(source, keys), "merge-source")
    return anti_join(base, staged, keys).unionByName(staged)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove the rows for which the condition holds; where it is NULL the row stays."""
    return df.where(F.coalesce(~condition, F.lit(True)))


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition holds; all expressions see the old row."""
    return df.withColumns({c: F.when(condition, e).otherwise(F.col(c)) for c, e in assignments.items()})


def open_history(df: DataFrame, at: datetime, valid_from: str = "valid_from",
                 valid_to: str = "valid_to") -> DataFrame:
    """First load of a history table: every row is an open version."""
    return df.withColumns({valid_from: moment(at), valid_to: moment(OPEN_END)})


def scd2_apply(history: DataFrame, changes: DataFrame, keys: Sequence[str], at: datetime,
               compare: Sequence[str] = (), valid_from: str = "valid_from", valid_to: str = "valid_to",
               skip_null_keys: bool = False) -> DataFrame:
    """Close the open version of each changed key and open a new one from ``at`` on.

    Keys without an open version get their first. With ``compare``, a key whose
    listed columns are all unchanged keeps its version. Applying the same
    changes at the same time again changes nothing; a change that lies before
    the open version is an error, as are two changes of one key and a change without
    a key; with ``skip_null_keys`` changes without a key are left out. The changes are
    stored on the way, so a small set of them is sent to the history and the
    history is never shuffled for it.
    """
    start, end = moment(at), moment(OPEN_END)
    compared = [c for c in compare if c not in keys]
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    named = changes.where(~unknown) if skip_null_keys else changes.where(_fail_if(unknown, "a change has no key"))
    staged = materialize(unique_by_key(named, keys), "scd-changes")
    current = _touched(history.where(F.col(valid_to) == end), staged, keys, [*keys, valid_from, *compared])
    current = current.select(*[F.col(c).alias("_c_" + c) for c in current.columns])
    began = F.col("_c_" + valid_from)
    changed = F.lit(not compared)
    for name in compared:
        changed = changed | ~F.col(name).eqNullSafe(F.col("_c_" + name))
    accepted = (staged.join(current, _same(keys, "_c_"), "left")
                .where(_fail_if(began > start, "a change lies before the open version"))
                .where(began.isNull() | ((began < start) & changed))
                .select(*changes.columns))
    accepted = materialize(accepted, "scd-accepted")
    closed = accepted.select(*[F.col(k).alias("_t_" + k) for k in keys])
    closing = (F.col(valid_to) == end) & F.col("_t_" + keys[0]).isNotNull()
    kept = (history.join(closed, _same(keys, "_t_"), "left")
            .withColumn(valid_to, F.when(closing, start).otherwise(F.col(valid_to)))
            .select(*history.columns))
    return kept.unionByName(accepted.withColumns({valid_from: start, valid_to: end}))


def last_changes(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change of every key, deletions included.

    ``append_version`` with keys sees to it that a version holds one change per key;
    in other logs the later time and then a hash of the row decide. The rank limit keeps
    one row per key and task before the shuffle.
    """
    latest = Window.partitionBy(*keys).orderBy(
        F.desc(VERSION), F.desc(TIME), F.desc(F.xxhash64(*hashable_columns(log))))
    return log.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")


def as_of(log: DataFrame, keys: Sequence[str], version: int | None = None,
          timestamp: datetime | None = None) -> DataFrame:
    """State of a change log at a version or a time: the last change per key, deletions left out.

    Later versions are cut off at the scan. ``change_log.read_as_of`` gives the same
    from a snapshot, without ranking the whole log.
    """
    if (version is None) == (timestamp is None):
        raise ValueError("give a version or a timestamp")
    if version is not None:
        seen = log.where(F.col(VERSION) <= F.lit(version))
    else:
        seen = log.where(F.col(TIME) <= moment(timestamp))
    return last_changes(seen, keys).where(F.col(OP) != DELETE)


def change_history(log: DataFrame, last: int | None = None) -> DataFrame:
    """Versions of a change log with operation, rows and time, the newest first."""
    history = (log.groupBy(VERSION, OP)
               .agg(F.count(F.lit(1)).alias("rows"), F.min(TIME).alias("first_ts"),
                    F.max(TIME).alias("last_ts"))
               .orderBy(F.desc(VERSION), F.asc(OP)))
    return history.limit(last) if last else history


def output_sizes(log: DataFrame) -> DataFrame:
    """How often each number of changed rows occurs among the versions."""
    return log.groupBy(VERSION).agg(F.count(F.lit(1)).alias("rows")).groupBy("rows").agg(
        F.count(F.lit(1)).alias("versions"))
