"""Kafka scans. The connector is not part of PySpark: supply its package to the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Options shared by the batch and the stream scan."""
    if not servers or not topic:
        raise ValueError("servers and topic are needed")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **extra}


def scan(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """Everything the topic holds now; the payload is the binary column ``value``."""
    return spark.read.format("kafka").options(**options(servers, topic, **extra)).load()


def stream(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**options(servers, topic, **extra)).load()
