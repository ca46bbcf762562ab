"""History from raw prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwatch.operators import scd2
from shelfwatch.sinks.tables import publish_version, read_current


def history_from_files(prices: DataFrame, chain: str | None = None) -> DataFrame:
    """Full price files to versions: filter, latest per day, typed, built in one pass."""
    return scd2.build_versions(scd2.daily_observations(scd2.full_files(prices, chain=chain)))


def refresh_history(spark: SparkSession, prices: DataFrame, root: str, chain: str | None = None) -> int:
    """Merge newer full files into the current version of the table and publish the next one."""
    daily = scd2.daily_observations(scd2.full_files(prices, chain=chain))
    before = read_current(spark, root)
    after = scd2.build_versions(daily) if before is None else scd2.merge_batch(before, daily)
    return publish_version(spark, after, root)
