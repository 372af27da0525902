"""Order, limits and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows in a total order: each task keeps k rows and no full sort runs."""
    return df.orderBy(*order).limit(k)


def union_all(*frames: DataFrame, by_position: bool = False) -> DataFrame:
    """Rows of all frames, matched by column name unless told otherwise; duplicates stay."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame) if by_position else result.unionByName(frame)
    return result


def common_columns(left: DataFrame, right: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names that both frames have, in the order of the left one: candidate join keys."""
    names = set(right.columns) - set(exclude)
    return [c for c in left.columns if c in names]
