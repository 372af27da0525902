"""From documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns a frame that is
written as Parquet and read again as the next stage's docs. Null and empty texts
do not survive the quality rules. Rows equal in key and text are one document to the
line stage; of repeated rows, and of texts tied in a group of near copies, the
near-copy stage keeps one, the one with the smallest key, then content hash; null
keys come last. Stages name only the columns they use, so further columns, of any
name, pass through to the last stage, which returns the packed pieces. An empty
table gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.decontaminate import drop_leaks
from millrace.llm.line_chunks import PASSAGE, dedup_lines
from millrace.llm.near_copies import drop_near_duplicates
from millrace.llm.packing import packed_texts
from millrace.llm.quality_rules import quality_filter
from millrace.workspace import new_path, remove, staging_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat themselves, or have hardly any words, go."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of two lines, or of one long line, that stood in an earlier document go; ``n_chars`` follows the text."""
    found = dedup_lines(docs, alone=PASSAGE)
    if "n_chars" not in docs.columns:
        return found
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash fingerprints within 3 bits, then 0.8 of the runs of five words."""
    return drop_near_duplicates(docs, similarity=0.8, by="marks")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of whole documents in sequences of 2048 words."""
    return packed_texts(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("best_fit_packing", best_fit_packing)]

#: The stages use hashes and greedy packing that SQL cannot state; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. What a stage staged, and its input, go once its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with staging_scope(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
