"""Projections and column changes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select with an explicit output name for every column."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name)
                       for name, c in columns.items()])


def select_exprs(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Select SQL expression strings, each under its output name."""
    return df.select(*[F.expr(text).alias(name) for name, text in expressions.items()])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old to new; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def derive_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection; every expression sees the input row."""
    return df.withColumns(dict(columns))


def drop_columns(df: DataFrame, *names: str, suffix: str | None = None) -> DataFrame:
    """Drop by name, and by suffix; names that are absent are ignored."""
    matched = [c for c in df.columns if suffix and c.endswith(suffix)]
    return df.drop(*names, *matched)


def normalize_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Make names safe for any file format: a bracketed unit goes, other odd characters become ``_``."""
    cleaned = []
    for name in df.columns:
        name = re.sub(r"\([^)]*\)$", "", name)
        name = re.sub(r"[ ,;{}()\n\t=]+", "_", name.strip())
        cleaned.append(name.lower() if lower else name)
    clashes = sorted({n for n in cleaned if cleaned.count(n) > 1})
    if clashes:
        raise ValueError(f"several columns would be called {clashes}")
    return df.toDF(*cleaned)


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns by type name. Values that do not fit become NULL, or raise when ``strict``."""
    return df.withColumns({c: F.col(c).cast(t) if strict else F.col(c).try_cast(t)
                           for c, t in types.items()})


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def unique_row_id() -> Column:
    """A number that is unique within one run but changes with the partitioning."""
    return F.monotonically_increasing_id()


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns that Spark can hash: all but those that hold maps or variants."""
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def spread(df: DataFrame) -> Column:
    """A number that differs between rows and between copies of a row in different partitions.

    Unlike a random number it is the same when a lost task runs again.
    """
    row = F.xxhash64(*(hashable_columns(df) or [F.lit(0)]))
    return row.bitwiseXOR(F.spark_partition_id().cast("bigint"))


def stable_row_id(columns: Sequence[str]) -> Column:
    """A 64-bit hash of the columns: the same on every run, equal for equal rows."""
    return F.xxhash64(*columns)


def with_work_date(df: DataFrame, day: date, name: str = "work_date") -> DataFrame:
    """Add the date that a run stands for; given by the caller, so that a later run gives the same rows."""
    return df.withColumn(name, F.lit(day))
