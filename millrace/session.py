"""Session defaults. Operators never touch session configuration; it is set here once."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings that hold on a laptop and on a cluster alike.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keyed stream state lives on disk instead of in the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_builder(app_name: str, shared_folder: str) -> SparkSession.Builder:
    """Builder for a cluster; the master comes from spark-submit.

    ``shared_folder`` must be visible to every executor: reliable checkpoints,
    stream checkpoints and staged tables go there.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.checkpoint.dir", shared_folder)
    for key, value in COMMON.items():
        builder = builder.config(key, value)
    # Shuffles start fine-grained and adaptive execution merges what is small;
    # the lower number counts for stream state, which keeps its partitioning.
    return (builder
            .config("spark.sql.shuffle.partitions", "2000")
            .config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "20000")
            .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
            .config("spark.sql.files.maxPartitionBytes", "256m"))


def local_session(app_name: str = "millrace", cores: int | str = "*", **extra: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in COMMON.items():
        builder = builder.config(key, value)
    builder = (builder
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.driver.bindAddress", "127.0.0.1")
               .config("spark.ui.enabled", "false"))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
