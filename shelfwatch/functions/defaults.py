"""Null defaults and sentinels of the enriched fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
DEFAULTED = ["city", "reshet_name", "storename", "address"]
ZIP_SENTINEL = "-999"


def fill_unknown(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(UNKNOWN, subset=columns or DEFAULTED)


def zip_text(zipcode: Column) -> Column:
    """'unknown' -> '-999'; null stays null. Kept as text so that '12-3' still casts to null later."""
    return F.when(zipcode == "unknown", F.lit(ZIP_SENTINEL)).otherwise(zipcode)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
