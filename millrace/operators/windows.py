"""Window results that stay evenly spread when one partition key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.workspace import materialize


def _match(keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(prefix + key))
    return condition


def _attach(df: DataFrame, lookup: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Left join to a lookup with one row per key, NULL keys included.

    The lookup is stored first. Spark then knows its true size: a small one is
    broadcast and the detail side stays where it is, a large one is joined by
    sort-merge, where adaptive execution splits hot keys.
    """
    renamed = lookup.withColumnsRenamed({k: "_g_" + k for k in keys})
    return df.join(materialize(renamed, label), _match(keys, "_g_"), "left").drop(*["_g_" + k for k in keys])


def partition_aggregates(df: DataFrame, *grains: tuple[Sequence[str], Sequence[Column]]) -> DataFrame:
    """Attach per-group aggregates to every row, for one or more (keys, aggregates) pairs.

    Same result as aggregates over unordered windows, but groups are reduced
    before any shuffle and joined back, so a hot group never meets in one task.
    """
    if not all(keys for keys, _ in grains):
        raise ValueError("a total over all rows has no key to attach it by")
    result = df
    for keys, aggregates in grains:
        result = _attach(result, df.groupBy(*keys).agg(*aggregates), keys, "groups")
    return result


def join_group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Attach to each row the size of its group."""
    return partition_aggregates(df, (keys, [F.count(F.lit(1)).alias(name)]))


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, total: Column, total_name: str,
                   share_name: str) -> DataFrame:
    """Attach the group total of ``value`` and the share each row has in it."""
    attached = partition_aggregates(df, (keys, [total.alias(total_name)]))
    return attached.withColumn(
        share_name, F.col(value).cast("double") / F.nullif(F.col(total_name), F.lit(0.0)).cast("double"))


def _in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], label: str,
               blocks: int | None) -> DataFrame:
    """Cut the data into ordered blocks: rows equal in keys and order share a block.

    Without a number, adaptive execution sizes the blocks like any other
    partition. Stored once, because a range partitioning that is computed twice
    may be cut at different places.
    """
    count = [blocks] if blocks else []
    ranged = df.repartitionByRange(*count, *keys, *order).withColumn("_block", F.spark_partition_id())
    return materialize(ranged, label)


def _with_offset(blocks: DataFrame, keys: Sequence[str], per_block: Column) -> DataFrame:
    """Attach what all earlier blocks of the same group add up to. One row per group and block."""
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    marks = [*keys, "_block"]
    offsets = (blocks.groupBy(*marks).agg(per_block.alias("_sum"))
               .select(*marks, F.sum("_sum").over(earlier).alias("_before")))
    return _attach(blocks, offsets, marks, "offsets")


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
                blocks: int | None = None) -> DataFrame:
    """Number the rows of each group in a total ``order``, from 1, block by block.

    Without keys all rows are one group; it is never sorted in one task.
    """
    cut = _with_offset(_in_blocks(df, keys, order, "numbered", blocks), keys, F.count(F.lit(1)))
    within = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order))
    return cut.withColumn(name, within + F.coalesce(F.col("_before"), F.lit(0))).drop("_block", "_before")


def running_sum(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str,
                blocks: int | None = None) -> DataFrame:
    """Sum of ``value`` over the group up to and including the row; rows that tie share the result.

    Rows are first reduced to one per order value, before any shuffle, and those
    are summed block by block, so neither a hot group nor a hot order value meets in
    one task. The plan and the output type, that of ``sum``, are the same for every
    size. ``value`` should be a decimal for a result that does not depend on the
    order of addition.
    """
    marks = [*keys, order]
    kind = df.select(F.sum(value).alias("_value")).schema["_value"].dataType
    points = df.groupBy(*marks).agg(F.sum(value).alias("_value"))
    cut = _with_offset(_in_blocks(points, keys, [F.col(order)], "running", blocks), keys, F.sum("_value"))
    within = F.sum("_value").over(Window.partitionBy(*keys, "_block").orderBy(order))
    # A block or prefix without any known value adds nothing, but all-NULL so far stays NULL.
    total = F.when(within.isNull(), F.col("_before")).otherwise(within + F.coalesce(F.col("_before"), F.lit(0)))
    summed = cut.select(*[F.col(m).alias("_p_" + m) for m in marks], total.cast(kind).alias(name))
    summed = materialize(summed, "sums")
    return df.join(summed, _match(marks, "_p_"), "left").drop(*["_p_" + m for m in marks])
