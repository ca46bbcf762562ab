"""Message logs as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.sources.files import REMEMBER_FILES
from shelfwatch.sources.schemas import MESSAGE


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """A topic from its start or from the checkpoint. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return reader.load().select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset"
    )


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A message log kept as Parquet files."""
    reader = spark.readStream.schema(MESSAGE).option("maxFileAge", REMEMBER_FILES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)
