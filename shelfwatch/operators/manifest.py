"""What has been delivered, and what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.filenames import landed_name, target_of


def file_manifest(rows: DataFrame, prefix: str = "") -> DataFrame:
    """One line per file: rows and time span. The prefix filter reaches the scan."""
    return (
        rows.filter(F.col("file_name").startswith(prefix))
        .groupBy("file_name")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("file_date").alias("first_date"),
            F.max("file_date").alias("last_date"),
        )
    )


def object_listing(spark, path: str, glob: str | None = None) -> DataFrame:
    """Recursive listing of a location; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "modificationTime", "length")


def named(names: DataFrame) -> DataFrame:
    """File names with the name of the object each lands as, and their target table."""
    return names.withColumns(
        {"landed_name": landed_name(F.col("file_name")), "target": target_of(F.col("file_name"))}
    )


def new_files(discovered: DataFrame, landed: DataFrame) -> DataFrame:
    """Discovered files whose landed object does not exist yet, with their target table.

    Both sides are distinct names, so the anti join has no repeated keys.
    """
    names = named(discovered.select("file_name").distinct())
    return names.join(landed.select("landed_name").distinct(), "landed_name", "left_anti")


def duplicate_names(listing: DataFrame, column: str = "file_name") -> DataFrame:
    return listing.agg(
        F.count(column).alias("n_names"), F.countDistinct(column).alias("n_distinct")
    ).withColumn("n_duplicates", F.col("n_names") - F.col("n_distinct"))
