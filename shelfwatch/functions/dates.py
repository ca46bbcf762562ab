"""Calendar and staleness columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STALE_AFTER_DAYS = 60


def is_weekend(stamp: Column) -> Column:
    """Friday and Saturday, from the locale-free day number; a missing date is not a weekend."""
    return F.coalesce(F.dayofweek(stamp).isin(6, 7), F.lit(False))


def with_calendar(df: DataFrame) -> DataFrame:
    run = F.col("run_time")
    return df.withColumns(
        {
            "snapshot": F.to_date(run),
            "snapshot_month": F.date_format(run, "MMMM"),
            "snapshot_quarter": F.concat_ws(
                " - ", F.date_format(run, "yyyy"), F.quarter(run).cast("string")
            ),
            "is_weekend": is_weekend(F.col("file_date")),
        }
    )


def with_staleness(df: DataFrame, limit_days: int = STALE_AFTER_DAYS) -> DataFrame:
    """Days between the file and the price's last change; an unreadable date counts as fresh."""
    days = F.datediff(F.to_date("file_date"), F.col("priceupdatedate").try_cast("date"))
    return df.withColumn("days_since_last_price_update", days).withColumn(
        "is_price_update_stale",
        F.when(F.col("days_since_last_price_update") > limit_days, 1).otherwise(0),
    )
