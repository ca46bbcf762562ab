"""Point-in-time lookup into the price history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.sources.schemas import ENTITY

VERSION = ["itemname", "itemprice", "StartDate", "EndDate"]


def valid_on(history: DataFrame, day) -> DataFrame:
    """All versions valid on one day."""
    return history.filter(
        (F.col("StartDate") <= day) & (F.col("EndDate").isNull() | (F.col("EndDate") > day))
    )


def as_of(probes: DataFrame, history: DataFrame, day: str = "as_of") -> DataFrame:
    """Add to each probe (entity and day) the version valid on that day, or nulls.

    The range condition never multiplies rows: the distinct (entity, day) pairs and the versions
    are put on one time line per entity, and each pair takes the last version started. The pairs
    are collapsed before the shuffle, so a time line is bounded by the calendar even when one
    entity holds a large share of the probes; those rows only meet again in an equi-join whose
    other side is unique, which AQE splits when skewed.
    """
    wanted = probes.select(*ENTITY, F.col(day).alias("_day")).dropna().distinct()
    starts = history.select(
        *ENTITY, F.col("StartDate").alias("_day"), F.lit(0).alias("_kind"), F.struct(*VERSION).alias("_v")
    )
    line = starts.unionByName(wanted.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(*ENTITY).orderBy("_day", "_kind")
    last = F.last("_v", ignorenulls=True).over(order)
    found = (
        line.withColumn("_v", last)
        .filter((F.col("_kind") == 1) & (F.col("_v.EndDate").isNull() | (F.col("_day") < F.col("_v.EndDate"))))
        .select(*ENTITY, F.col("_day").alias(day), "_v.*")
    )
    return probes.join(found, [*ENTITY, day], "left")
