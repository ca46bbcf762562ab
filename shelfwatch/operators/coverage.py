"""Which expected deliveries are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gaps(
    expected: DataFrame, delivered: DataFrame, keys: list[str], day: str, first: Column, last: Column
) -> DataFrame:
    """Stretches of days from ``first`` to ``last`` that an expected key did not deliver.

    One row per stretch: the key, first_day, last_day, n_days; so the result grows with the gaps and
    not with the days. The expected grid is not built. Delivered days are made distinct before the
    shuffle, each expected key adds the days just outside the range, and a gap lies between two
    neighbouring days. ``first`` and ``last`` may be scalar subqueries over what was delivered.
    """
    names = expected.select(*keys).dropna().distinct()
    known = delivered.select(*keys, F.col(day).alias("_day")).distinct()
    inside = known.filter((F.col("_day") >= first) & (F.col("_day") <= last)).join(names, keys, "left_semi")
    edges = names.select(
        *keys, F.explode(F.array(F.date_sub(first, 1), F.date_add(last, 1))).alias("_day")
    )
    after = F.lead("_day").over(Window.partitionBy(*keys).orderBy("_day"))
    found = inside.unionByName(edges).withColumn("_next", after).filter(F.datediff("_next", "_day") > 1)
    return found.select(
        *keys,
        F.date_add("_day", 1).alias("first_day"),
        F.date_sub("_next", 1).alias("last_day"),
        (F.datediff("_next", "_day") - 1).alias("n_days"),
    )


def missing_days(
    expected: DataFrame, delivered: DataFrame, keys: list[str], day: str, first: Column, last: Column
) -> DataFrame:
    """The gaps day by day: every (key, day) that an expected key did not deliver."""
    found = gaps(expected, delivered, keys, day, first, last)
    return found.select(*keys, F.explode(F.sequence("first_day", "last_day")).alias(day))
