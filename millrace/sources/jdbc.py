"""JDBC scans and writes; the driver jar and the database are the caller's."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Whole table over one connection: for small tables only."""
    return spark.read.jdbc(url, table, properties=properties or {})


def range_options(column: str, lower: Any, upper: Any, partitions: int) -> dict[str, Any]:
    """Reader options of a scan split into ranges of ``column``.

    The bounds only place the cuts: rows outside them, and NULLs, still arrive.
    """
    if partitions < 1:
        raise ValueError("at least one partition is needed")
    if lower >= upper:
        raise ValueError("the lower bound must lie below the upper bound")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def bounds_query(table: str, column: str) -> str:
    """Subquery that lets the database find the bounds for a split scan."""
    return f"(SELECT min({column}) AS lower_bound, max({column}) AS upper_bound FROM {table}) bounds"


def scan_ranges(spark: SparkSession, url: str, table: str, column: str, partitions: int,
                lower: Any = None, upper: Any = None, properties: dict[str, str] | None = None,
                fetch_size: int = 10_000) -> DataFrame:
    """Table read over ``partitions`` connections; missing bounds are asked for first."""
    if lower is None or upper is None:
        found = scan(spark, url, bounds_query(table, column), properties).agg(
            F.min("lower_bound").alias("lo"), F.max("upper_bound").alias("hi")).first()
        lower = found.lo if lower is None else lower
        upper = found.hi if upper is None else upper
        if lower is None or lower >= upper:
            return scan(spark, url, table, properties)
    options = {**(properties or {}), **range_options(column, lower, upper, partitions)}
    return (spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_size, **options)
            .load())


def write(df: DataFrame, url: str, table: str, connections: int, mode: str = "append",
          properties: dict[str, str] | None = None, batch_size: int = 10_000) -> None:
    """Write over ``connections`` connections, one per partition.

    The exchange keeps the work before it as parallel as it was; merging
    partitions without one would run all of it in as many tasks as connections.
    """
    (df.repartition(connections).write
       .option("batchsize", batch_size).jdbc(url, table, mode=mode, properties=properties or {}))
