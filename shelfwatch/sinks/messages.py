"""Publish rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.messages import encode


def publish_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the class path."""
    (
        encode(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_files(messages: DataFrame, path: str) -> None:
    """A batch of a file-backed message log: value, topic, partition and offset."""
    messages.select(
        "value", "topic", F.col("partition").cast("int"), F.col("offset").cast("long")
    ).write.mode("append").parquet(path)
