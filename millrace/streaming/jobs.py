"""Stream transformations. All but the watermark ones give the same result on a static frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import checked_broadcast


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Event times with a zone, as watermarks need them."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def grouped_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def windowed(df: DataFrame, keys: Sequence[str], time: str, length: str, aggregates: Sequence[Column],
             watermark: str | None = None) -> DataFrame:
    """Aggregates per key and tumbling event-time window.

    With a watermark, windows are final and leave the state once the watermark
    has passed them, and later rows for them are dropped; without one, state grows with the number of windows.
    """
    df = event_time(df, time)
    if watermark:
        df = df.withWatermark(time, watermark)
    grouped = df.groupBy(*keys, F.window(time, length).alias("_window")).agg(*aggregates)
    others = [c for c in grouped.columns if c not in (*keys, "_window")]
    return grouped.select(*keys, F.col("_window.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("_window.end").cast("timestamp_ntz").alias("window_end"), *others)


def windowed_with_dimension(df: DataFrame, key: str, time: str, length: str,
                            aggregates: Sequence[Column], dimension: DataFrame, dimension_key: str,
                            columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Windowed aggregates joined to a static table and sorted; sorting needs the complete mode.

    The dimension is joined after the aggregation, so it meets groups and not
    events, and is broadcast only when it is proven small.
    """
    counted = windowed(df, [key], time, length, aggregates)
    lookup = checked_broadcast(dimension.select(F.col(dimension_key).alias(key), *columns))
    return counted.join(lookup, key).orderBy(*order)
