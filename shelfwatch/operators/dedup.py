"""One record per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.sources.schemas import ENTITY


def latest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key in the given order.

    The optimizer pushes the ``rn = 1`` limit below the shuffle, so each task sends at most one
    row per key and a hot key reaches its reducer already collapsed.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_day(prices: DataFrame) -> DataFrame:
    """Latest record per item, chain, store and day; equal stamps fall back to name and values."""
    dated = prices.withColumn("file_day", F.to_date("file_date"))
    order = [
        F.desc("file_date"),
        F.desc("file_name"),
        F.desc("itemprice"),
        F.desc("itemname"),
    ]
    return latest_per(dated, [*ENTITY, "file_day"], order)


def latest_stores(stores: DataFrame) -> DataFrame:
    """Latest delivery per store, so that a changed address does not multiply the prices."""
    order = [
        F.desc("file_date"),
        F.desc("file_name"),
        *[F.desc_nulls_last(c) for c in ("storename", "address", "city", "zipcode")],
    ]
    return latest_per(stores, ["num_reshet", "storeid"], order)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
