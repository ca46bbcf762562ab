"""Relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwatch.sinks.jdbc import DRIVER


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    user: str,
    password: str,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Table scan; ``split`` is (numeric column, lower, upper, partitions) for a parallel read.

    The bounds only place the splits: rows outside them are still read.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("user", user)
        .option("password", password)
        .option("driver", DRIVER)
        .option("fetchsize", "10000")
    )
    if split:
        column, lower, upper, partitions = split
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()
