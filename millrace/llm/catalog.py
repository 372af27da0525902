"""The registered queries of the subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Modules that define QUERIES: name -> (plan, SQL or None).
MODULES = ("token_counts", "quality_rules", "url_rules", "license_scan", "simhash_dedup", "decontaminate",
           "line_chunks", "packing", "token_records", "katz", "phrases", "whitening",
           "winnowing")


@dataclass(frozen=True)
class TextQuery:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def queries() -> dict[str, TextQuery]:
    import corpus_pipeline

    found = {"pipeline": TextQuery("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}
    for module in MODULES:
        for name, (run, oracle) in import_module(f"millrace.llm.{module}").QUERIES.items():
            found[name] = TextQuery(name, run, oracle)
    return found
