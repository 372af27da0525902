"""Filters, missing data, duplicates and samples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep(df: DataFrame, *conditions: Column | str) -> DataFrame:
    """Rows for which all conditions hold; strings are SQL expressions."""
    for condition in conditions:
        df = df.where(condition)
    return df


def matches_ignoring_case(column: str, pattern: str) -> Column:
    """LIKE without regard to case."""
    return F.lower(F.col(column)).like(pattern.lower())


def replace_values(df: DataFrame, mapping: Mapping[Any, Any],
                   subset: Sequence[str] | None = None) -> DataFrame:
    """Replace values in all columns of the fitting type, or in ``subset`` only."""
    return df.replace(dict(mapping), subset=list(subset) if subset else None)


def fill_missing(df: DataFrame, value: Any, subset: Sequence[str] | None = None) -> DataFrame:
    """Fill NULLs: one value for all fitting columns or a subset, or a dict per column."""
    if isinstance(value, Mapping):
        return df.fillna(dict(value))
    return df.fillna(value, subset=list(subset) if subset else None)


def drop_missing(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None,
                 at_least: int | None = None) -> DataFrame:
    """Drop rows with NULLs; ``at_least`` keeps rows with that many known values."""
    return df.dropna(how=how, thresh=at_least, subset=list(subset) if subset else None)


def null_shares(columns: Sequence[str], prefix: str = "null_share_") -> list[Column]:
    """One share-of-NULLs aggregate per column, all computed in a single pass."""
    return [F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(prefix + c) for c in columns]


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column in one row."""
    return df.agg(*null_shares(columns or df.columns))


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in a total ``order``.

    The rank limit runs on the map side too, so a hot key sends one row per
    task and not its whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(window))
              .where(F.col("_rank") == 1).drop("_rank"))


def sample_rows(df: DataFrame, fraction: float, seed: int, with_replacement: bool = False) -> DataFrame:
    """Random sample; the rows chosen depend on the partitioning as well as on the seed."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def sample_stable(df: DataFrame, key: str, fraction: float, seed: str = "") -> DataFrame:
    """Sample by a digest of the key: the same rows on any cluster and in any file layout."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), 1, 8)
    return df.where(F.conv(digits, 16, 10).cast("long") < F.lit(int(fraction * 16 ** 8)))


def _digest(key: str, seed: str) -> Column:
    """A number below 16**8 that depends on the key and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), 1, 8)
    return F.conv(digits, 16, 10).cast("long")


def poisson_steps(rate: float) -> list[int]:
    """Digests from which on a row is drawn once, twice and so on: the cumulated Poisson shares of 16**8."""
    share, total, steps = math.exp(-rate), 0.0, []
    while (total := total + share) * 16 ** 8 < 16 ** 8 - 0.5:
        steps.append(int(total * 16 ** 8))
        share *= rate / len(steps)
    return steps


def sample_repeated(df: DataFrame, key: str, rate: float, seed: str = "") -> DataFrame:
    """Sample with replacement: a row comes ``rate`` times on average, the same number of times in any file layout.

    How often is read off the key's digest by the cumulated Poisson shares, so rows are
    drawn independently and nothing is shuffled. Rows of one key are drawn alike; rows
    without a key are not drawn.
    """
    if not 0 < rate <= 20:
        raise ValueError("the rate lies above 0 and up to 20")
    digest = _digest(key, seed)
    times = sum((F.when(digest >= F.lit(step), 1).otherwise(0) for step in poisson_steps(rate)), F.lit(0))
    name = "_draw"
    while name in df.columns:
        name += "_"
    return df.where(times > 0).withColumn(name, F.explode(F.sequence(F.lit(1), times))).drop(name)


def sample_exact(df: DataFrame, key: str, size: int, strata: Sequence[str] = (), seed: str = "") -> DataFrame:
    """``size`` rows of each stratum, or all of a smaller one: those with the smallest digests, ties by key.

    The same rows in any file layout if keys are unique. A task sends ``size`` rows of a
    stratum at most.
    """
    order = Window.partitionBy(*strata).orderBy(_digest(key, seed), F.col(key))
    name = "_rank"
    while name in df.columns:
        name += "_"
    return df.where(F.col(key).isNotNull()).withColumn(name, F.row_number().over(order)).where(F.col(name) <= size).drop(name)
