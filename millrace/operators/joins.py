"""Joins, with size checks for broadcasts and salting for hot keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from millrace.operators.project import spread
from millrace.operators.stats import frequent_items
from millrace.sources.writers import save_table
from millrace.workspace import materialize, new_name, new_path

_SALTED_TYPES = ("inner", "left", "leftsemi", "leftanti")

#: The rows of a key are repeated at most twice this often in a grid of cells.
REPEATS = 8

#: Pairs that a task of a grid makes, as far as its cells allow.
PAIRS = 5_000_000

#: Copies of rows that a task makes for the cells of a grid.
COPIES = 1_000_000

#: A bucket, which is a file of each side, has the pairs of so many tasks.
BUCKET_TASKS = 4

#: No more buckets are added for pairs; with more, Spark sorts the rows of a task by bucket before it writes them.
MOST_BUCKETS = 200


def small_enough(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> bool:
    """Is ``df`` proven to be within both bounds?

    The rows are counted first, which needs no column data; only columns of
    variable width of a frame of few rows are then measured.
    """
    if df.isStreaming:
        return False
    rows = df.count()
    if rows > max_rows:
        return False
    fixed = rows * 16 * len(df.columns)
    widths = [F.octet_length(F.col(f"`{name}`") if kind in ("string", "binary") else F.to_json(F.struct(f"`{name}`")))
              for name, kind in df.dtypes if kind in ("string", "binary") or "<" in kind]
    if not widths or fixed > max_bytes:
        return fixed <= max_bytes
    measured = df.agg(*[F.sum(w.cast("long")) for w in widths]).first()
    return fixed + sum(width or 0 for width in measured) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast when the size check passes; otherwise Spark chooses the join itself."""
    return F.broadcast(df) if small_enough(df, max_rows, max_bytes) else df


def join_on_keys(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on shared names; each key comes out once."""
    return left.join(right, on if isinstance(on, str) else list(on), how)


def join_on_condition(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Join on any expression, bound to frames or built beforehand from unbound columns."""
    return left.join(right, condition, how)


def join_prefixed(left: DataFrame, right: DataFrame, on: Sequence[str], prefix: str,
                  how: str = "inner") -> DataFrame:
    """Join on shared names; other names that both sides have get ``prefix`` on the right."""
    taken = set(left.columns) - set(on)
    renamed = right.withColumnsRenamed({c: prefix + c for c in right.columns if c in taken})
    return left.join(renamed, list(on), how)


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left side with a partner; never multiplied."""
    return left.join(_keys_of(right, on), list(on), "leftsemi")


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left side without a partner; NULL keys have none."""
    return left.join(_keys_of(right, on), list(on), "leftanti")


def _keys_of(df: DataFrame, on: Sequence[str]) -> DataFrame:
    # Duplicates vanish before the shuffle, so a hot key on this side costs one row per task.
    return df.select(*on).distinct()


def hot_keys(df: DataFrame, key: str, support: float = 0.02) -> DataFrame:
    """Keys that hold at least ``support`` of all rows; there are at most 1/support of them."""
    return frequent_items(df.where(F.col(key).isNotNull()), key, support).select(key)


def salt_sides(left: DataFrame, right: DataFrame, key: str, salts: int = 16, support: float = 0.02,
               salt_name: str = "_salt") -> tuple[DataFrame, DataFrame]:
    """Spread the hot keys of ``left`` over ``salts`` join partners.

    Left rows of a hot key get one salt each and right rows of it are repeated
    for every salt; other keys, and NULL, keep salt 0. Each pair still meets
    exactly once. The hot-key list has at most 1/support rows, hence the broadcast;
    it is stored once because both sides have to see the same list.
    """
    hot = F.broadcast(materialize(hot_keys(left, key, support).select(F.col(key).alias("_hot")), "hot-keys"))
    slot = F.pmod(spread(left), F.lit(salts)).cast("int")
    salted = (left.join(hot, F.col(key) == F.col("_hot"), "left")
              .withColumn(salt_name, F.when(F.col("_hot").isNotNull(), slot).otherwise(F.lit(0)))
              .drop("_hot"))
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0)))
    repeated = (right.join(hot, F.col(key) == F.col("_hot"), "left")
                .withColumn(salt_name, F.explode(copies)).drop("_hot"))
    return salted, repeated


def _grid(left: DataFrame, right: DataFrame, key: str, target_rows: int) -> tuple[DataFrame, Row]:
    """The stored list of frequent keys, into how many cells each side is cut; and what they have at most in all.

    That is their pairs, their cells, and the copies of rows of either side in cells.
    """
    def large(df: DataFrame, name: str) -> DataFrame:
        return (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > target_rows).select("_hot", F.col("_n").alias(name)))

    def cells(own: str, other: str) -> Column:
        repeated = F.floor(REPEATS * (F.col(own) + F.col(other)) / F.col(other))
        return F.least(F.ceil(F.col(own) / target_rows), repeated).cast("int").alias(own)

    def at_most(own: str) -> Column:
        return F.coalesce(own, F.lit(target_rows)).cast("double")

    # a key that is not in the list of a side has target_rows there at most, one cell
    counted = large(left, "_l").join(large(right, "_r"), "_hot", "full").select(
        "_hot", F.coalesce("_l", F.lit(1)).alias("_l"), F.coalesce("_r", F.lit(1)).alias("_r"),
        at_most("_l").alias("_left"), at_most("_r").alias("_right"))
    grid = materialize(counted.select("_hot", cells("_l", "_r"), cells("_r", "_l"), "_left", "_right"), "hot-keys")
    sums = {"pairs": F.col("_left") * F.col("_right"), "cells": F.col("_l").cast("double") * F.col("_r"),
            "left_copies": F.col("_left") * F.col("_r"), "right_copies": F.col("_right") * F.col("_l")}
    return grid.drop("_left", "_right"), grid.agg(
        *[F.coalesce(F.sum(value), F.lit(0.0)).alias(name) for name, value in sums.items()]).first()


def _dealt(left: DataFrame, right: DataFrame, key: str, grid: DataFrame, sums: Row) -> tuple[DataFrame, DataFrame]:
    hot = checked_broadcast(grid)

    def dealt(df: DataFrame, copies: float, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        # few tasks read a small table, and would make and sort the many copies of all its rows
        if copies > COPIES and copies > 4 * df.count():
            df = df.repartition(min(math.ceil(copies / COPIES), 100_000))
        known = df.join(hot, F.col(key) == F.col("_hot"), "left")
        # NULL meets nothing, so it may lie in any line
        count = F.when(F.col(key).isNull(), F.lit(REPEATS ** 2)).otherwise(F.col(own_count))
        slot = F.coalesce(F.pmod(spread(df), count).cast("int"), F.lit(0))
        cells = F.sequence(F.lit(0), F.coalesce(F.col(other_count), F.lit(1)) - 1)
        return known.withColumn(own, slot).withColumn(other, F.explode(cells))
    lines = dealt(left, sums.left_copies, "_line", "_l", "_column", "_r").withColumn("_columns", F.coalesce("_r", F.lit(1)))
    columns = dealt(right, sums.right_copies, "_column", "_r", "_line", "_l").withColumn("_hit", F.lit(True))
    return lines.drop("_hot", "_l", "_r"), columns.drop("_hot", "_l", "_r")


def _tasks(sums: Row) -> int | None:
    """How many tasks the pairs of frequent keys need, not more than there are cells; None where one does.

    Adaptive execution sees the bytes of the rows in cells alone, which say nothing of
    their pairs, and would give many cells to few tasks.
    """
    tasks = min(math.ceil(sums.pairs / PAIRS), int(sums.cells), 1_000_000)
    return tasks if tasks > 1 else None


def grid_by_share(left: DataFrame, right: DataFrame, key: str,
                  target_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """Cut each frequent key into a grid of cells by its counted share on both sides.

    A key with l and r rows gets ceil(l / target_rows) x ceil(r / target_rows) cells.
    A left row lies in one line of cells and is repeated along it, a right row in one
    column, so each pair meets in exactly one cell and no cell has much more than
    ``target_rows`` of a side; a key that is frequent on one side only is repeated on the
    other alone. Where so many cells would repeat the l + r rows more than ``REPEATS``
    times on a side, there are fewer and larger cells, so what is shuffled grows with the
    rows and not with the pairs; a key then still has more than ``REPEATS`` squared cells. Both sides get ``_line`` and ``_column``, the left one also ``_columns``,
    in how many cells its row is, and the right one ``_hit``. Other keys have one cell; so
    has a row whose key is NULL, in any line. The list of frequent keys has at most
    rows / target_rows entries a side.
    """
    return _dealt(left, right, key, *_grid(left, right, key, target_rows))


def _alike(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame, str]:
    """Both sides and the key to join on, which has one type on both.

    A join compares a date with a time, or two kinds of number, in the wider type. Rows that
    were hashed or stored by types of their own would be shuffled once more for that.
    """
    own, other = (df.select(key).schema[0].dataType for df in (left, right))
    kinds = NumericType, (DateType, TimestampType, TimestampNTZType)
    if own == other or not any(isinstance(own, kind) and isinstance(other, kind) for kind in kinds):
        return left, right, key
    wide = left.select(key).join(right.select(key), key, "full").schema[0].dataType
    cast = F.col(key).cast(wide)
    if own == wide:
        return left, right.withColumn(key, cast), key
    return left.withColumn("_key", cast), right.withColumn("_key", cast).drop(key), "_key"


def _salted(left: DataFrame, right: DataFrame, key: str, how: str, salts: int | None, support: float,
            target_rows: int | None) -> tuple[DataFrame, DataFrame, list[str], int | None]:
    """Both sides, what to join them on, and how many tasks their pairs need where that is counted."""
    if (salts or target_rows) and how not in _SALTED_TYPES:
        raise ValueError(f"salting repeats the right side, which a {how} join cannot have")
    if how in _SALTED_TYPES:
        left, right, key = _alike(left, right, key)
    if target_rows:
        # a semi or anti join needs each right key once, so nothing repeats the left side
        right = right if how in ("inner", "left") else _keys_of(right, [key])
        grid, sums = _grid(left, right, key, target_rows)
        return *_dealt(left, right, key, grid, sums), [key, "_line", "_column"], _tasks(sums)
    if salts:
        return *salt_sides(left, right, key, salts, support), [key, "_salt"], None
    return left, right, [key], None


def _unsalted(joined: DataFrame, key: str) -> DataFrame:
    """The result without helper columns. A left row in several cells has a partner, so its lone copies go."""
    if {"_columns", "_hit"} <= set(joined.columns):
        joined = joined.where((F.col("_columns") == 1) | F.col("_hit").isNotNull())
    if "_key" in joined.columns:
        joined = joined.select(key, *[c for c in joined.columns if c not in (key, "_key")])
    return joined.drop("_salt", "_line", "_column", "_columns", "_hit")


def join_prepartitioned(left: DataFrame, right: DataFrame, key: str, partitions: int | None = None,
                        how: str = "inner", salts: int | None = None, support: float = 0.02,
                        target_rows: int | None = None) -> DataFrame:
    """Hash both sides on the join key first, so the join adds no exchange of its own.

    Adaptive skew handling leaves explicit partitionings alone. ``target_rows``
    cuts every key that is larger on either side, or on both, into a grid of cells of
    that size; ``salts`` spreads the keys of the left side beyond ``support`` evenly.
    """
    left, right, keys, tasks = _salted(left, right, key, how, salts, support, target_rows)
    partitions = partitions or tasks
    count = [partitions] if partitions else []
    joined = left.repartition(*count, *keys).join(right.repartition(*count, *keys), keys, how)
    return _unsalted(joined, key)


def join_grid(left: DataFrame, right: DataFrame, key: str, target_rows: int = 1_000_000, how: str = "inner") -> DataFrame:
    """Join that takes keys frequent on both sides, see ``grid_by_share``; inner, left, leftsemi or leftanti.

    Unlike adaptive skew handling it is certain, and it splits both sides of a key. Cells
    are dealt to a task for every ``PAIRS`` pairs.
    """
    left, right, keys, tasks = _salted(left, right, key, how, None, 0.0, target_rows)
    if tasks:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return _unsalted(left.join(right, keys, how), key)


def join_bucketed(left: DataFrame, right: DataFrame, key: str, buckets: int, how: str = "inner",
                  salts: int | None = None, support: float = 0.02, label: str = "bucketed",
                  target_rows: int | None = None) -> DataFrame:
    """Store both sides bucketed alike and join the stored tables without any exchange.

    Worth it when the tables are joined more than once. With ``target_rows`` or
    ``salts`` the bucket key has the cell or the salt too, so a hot key fills several buckets.
    One task joins a bucket; where ``target_rows`` counts more pairs of frequent keys than
    ``buckets`` tasks should make, there is a bucket for every ``BUCKET_TASKS`` x ``PAIRS`` of
    them, up to ``MOST_BUCKETS``.
    """
    left, right, keys, tasks = _salted(left, right, key, how, salts, support, target_rows)
    buckets = max(buckets, min(math.ceil((tasks or 0) / BUCKET_TASKS), MOST_BUCKETS))
    sides = []
    for side in (left, right):
        name = new_name(label)
        sides.append(save_table(side, name, path=new_path(side.sparkSession, label),
                                bucket_by=keys, buckets=buckets))
    return _unsalted(sides[0].join(sides[1].hint("merge"), keys, how), key)
