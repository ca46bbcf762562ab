"""Retention and archiving by partition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.sinks.tables import delete_path, partition_values, write_partitioned

KEEP_DAYS = 7


def cutoff(today: Column, days: int = KEEP_DAYS) -> Column:
    return F.date_sub(today, days)


def keep(df: DataFrame, today: Column, days: int = KEEP_DAYS, column: str = "snapshot") -> DataFrame:
    """Rows after the cutoff day; rows without a day are kept."""
    return df.filter(F.col(column).isNull() | (F.col(column) > cutoff(today, days)))


def expired(df: DataFrame, today: Column, days: int = KEEP_DAYS, column: str = "snapshot") -> DataFrame:
    return df.filter(F.col(column) <= cutoff(today, days))


def retention_metrics(
    df: DataFrame, today: Column, days: int = KEEP_DAYS, column: str = "snapshot"
) -> DataFrame:
    old = F.coalesce(F.col(column) <= cutoff(today, days), F.lit(False))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(old).alias("n_expired"),
        F.count_if(~old).alias("n_kept"),
    )


def _expired_days(spark: SparkSession, path: str, last_expired: dt.date, column: str) -> list[str]:
    days = partition_values(spark, path, column)
    return [d for d in days if d[:1].isdigit() and dt.date.fromisoformat(d) <= last_expired]


def drop_expired(
    spark: SparkSession, path: str, today: dt.date, days: int = KEEP_DAYS, column: str = "snapshot"
) -> list[str]:
    """Remove whole expired partitions; no row is read or rewritten."""
    gone = _expired_days(spark, path, today - dt.timedelta(days=days), column)
    for day in gone:
        delete_path(spark, f"{path}/{column}={day}")
    return gone


def archive(
    spark: SparkSession,
    path: str,
    archive_path: str,
    today: dt.date,
    days: int = KEEP_DAYS,
    column: str = "snapshot",
    delivery: Column | None = None,
) -> list[str]:
    """Move expired partitions to an archive partitioned by month, day and delivery.

    A delivery is the batch that landed the rows, if the caller names it, else a source file, known
    by its name, which no later file has. So what comes late for a day that was archived before is
    added to it, and a repeated run replaces only what it wrote itself. The originals go only after the archive was read back and every delivery has as many
    rows as its source.
    """
    last_expired = today - dt.timedelta(days=days)
    gone = _expired_days(spark, path, last_expired, column)
    if not gone:
        return []
    old = spark.read.parquet(path).filter(F.col(column) <= F.lit(last_expired))
    old = old.withColumns(
        {
            "archive_month": F.date_format(column, "yyyy-MM"),
            "delivery": F.hex(F.xxhash64(F.col("_metadata.file_name"))) if delivery is None else delivery.cast("string"),
        }
    )
    write_partitioned(old, archive_path, ["archive_month", column, "delivery"])

    each = [column, "delivery"]
    wanted = old.groupBy(*each).agg(F.count("*").alias("n"))
    # Read as text: a name of digits only must not turn into a number.
    whole = T.StructType([T.StructField(column, T.DateType()), T.StructField("delivery", T.StringType())])
    stored = spark.read.schema(whole).parquet(archive_path).filter(F.col(column) <= F.lit(last_expired))
    stored = stored.groupBy(*each).agg(F.count("*").alias("m"))
    lost = wanted.join(stored, each, "left").filter(~F.col("n").eqNullSafe(F.col("m")))
    if not lost.isEmpty():
        raise RuntimeError("archive is incomplete, the originals stay")
    for day in gone:
        delete_path(spark, f"{path}/{column}={day}")
    return gone
