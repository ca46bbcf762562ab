"""JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Times are written with all their six digits; reading takes any number of them.
EXACT_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
LOG_COLUMNS = ["topic", "partition", "offset"]


def encode(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row as one JSON ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns)), EXACT_TIME).alias("value"))


def decode(messages: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """``value`` parsed by schema, with the log position; what does not parse becomes nulls."""
    keep = LOG_COLUMNS if keep is None else keep
    parsed = messages.select(F.from_json("value", schema).alias("j"), *keep)
    return parsed.select("j.*", *keep)


def progress(messages: DataFrame) -> DataFrame:
    """Highest offset seen per topic and partition."""
    return messages.groupBy("topic", "partition").agg(F.max("offset").alias("latest_offset"))


STRETCH = 1_000_000
_LOG = ["topic", "partition"]


def _runs(offsets: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Adjoining or overlapping intervals of a key as one each."""
    by_start = Window.partitionBy(*key).orderBy(start)
    reached = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col(start) > reached + 1, F.lit(True)).cast("int")
    grouped = offsets.withColumn("_new", new).withColumn("_run", F.sum("_new").over(by_start))
    return grouped.groupBy(*key, "_run").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_run")


def audit(messages: DataFrame) -> DataFrame:
    """Stretches of offsets that are ``lost`` between a partition's first and last one, or ``repeated``.

    One row per stretch: topic, partition, kind, first_offset, last_offset, n_offsets. Offsets are
    merged into runs in stretches of ``STRETCH`` first, so a partition with most of the messages is
    many groups; the runs of all its stretches, which are few unless much is lost, are merged again.
    """
    seen = messages.filter(F.col("offset").isNotNull()).groupBy(*_LOG, "offset").agg(F.count("*").alias("n"))
    place = F.col("offset")
    seen = seen.withColumns({"first": place, "last": place, "_stretch": F.floor(place / STRETCH)})

    def merged(rows: DataFrame) -> DataFrame:
        parts = _runs(rows.select(*_LOG, "_stretch", "first", "last"), [*_LOG, "_stretch"], "first", "last")
        return _runs(parts, _LOG, "first", "last")

    there = merged(seen)
    after = F.lead("first").over(Window.partitionBy(*_LOG).orderBy("first"))
    lost = there.withColumn("_next", after).filter(F.col("_next").isNotNull())
    lost = lost.select(*_LOG, F.lit("lost").alias("kind"), (F.col("last") + 1).alias("first"), (F.col("_next") - 1).alias("last"))
    repeated = merged(seen.filter(F.col("n") > 1)).select(*_LOG, F.lit("repeated").alias("kind"), "first", "last")
    return lost.unionByName(repeated).select(
        *_LOG, "kind", F.col("first").alias("first_offset"), F.col("last").alias("last_offset"), (F.col("last") - F.col("first") + 1).alias("n_offsets")
    )
