"""Name, plan and SQL statement of every query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


class Tables:
    """The given tables by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, covers: str, oracle: str | None = None):
    """Register a plan under ``name``; ``covers`` lists the inventory entries it shows."""
    def add(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(name, tuple(covers.split()),
                               lambda spark, folder: plan(Tables(spark, folder)), oracle)
        return plan
    return add
