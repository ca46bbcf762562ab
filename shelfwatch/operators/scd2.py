"""Type-2 price history.

A version is valid for ``StartDate <= day < EndDate``; the active version has no ``EndDate``. The
item name is the one first seen for the entity, also on later versions.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.functions.casts import convert_columns
from shelfwatch.functions.filenames import FULL_PREFIX
from shelfwatch.operators.dedup import latest_per, latest_per_day
from shelfwatch.sources.schemas import ENTITY, SCD

OBSERVED_TYPES = {"itemcode": "bigint", "itemprice": "price", "num_reshet": "bigint", "num_snif": "int"}
_REQUIRED = [*ENTITY, "file_date"]
DAILY = [*ENTITY, "itemname", "itemprice", "file_date", "observed_at", "file_name"]


def full_files(prices: DataFrame, prefix: str = FULL_PREFIX, chain: str | None = None) -> DataFrame:
    """Rows from full price files, optionally of one chain."""
    kept = prices.filter(F.col("file_name").startswith(prefix))
    return kept if chain is None else kept.filter(F.col("num_reshet") == chain)


def rejected_observations(prices: DataFrame) -> DataFrame:
    """The rows ``daily_observations`` cannot place: no readable key or no date."""
    typed = convert_columns(prices.select("*", F.struct("*").alias("_raw")), OBSERVED_TYPES)
    complete = reduce(and_, [F.col(c).isNotNull() for c in _REQUIRED])
    return typed.filter(~complete).select("_raw.*")


def last_observations(prices: DataFrame) -> DataFrame:
    """Raw prices to the last typed observation per entity and day, readable price or not.

    Keys are typed before the rows are compared, so '07' and '7' are one store. Rows without a
    complete key would all meet in one group and can never match; see ``rejected_observations``.
    """
    typed = convert_columns(prices, OBSERVED_TYPES).dropna(subset=_REQUIRED)
    return (
        latest_per_day(typed)
        .withColumn("observed_at", F.col("file_date"))
        .withColumn("file_date", F.col("file_day"))
        .select(*DAILY)
    )


def priced(daily: DataFrame) -> DataFrame:
    """The day's last observation decides: without a readable price the day tells nothing."""
    return daily.filter(F.col("itemprice").isNotNull())


def daily_observations(prices: DataFrame) -> DataFrame:
    """At most one priced observation per entity and day."""
    return priced(last_observations(prices))


def build_versions(daily: DataFrame) -> DataFrame:
    """History from daily observations in one pass, whatever order they arrived in.

    All windows share one partitioning and order: one shuffle, one sort. An entity has at most one
    row per calendar day, which bounds every window group.
    """
    by_day = Window.partitionBy(*ENTITY).orderBy("file_date")
    changes = daily.withColumns(
        {
            "_before": F.lag("itemprice").over(by_day),
            "_name": F.first("itemname").over(by_day),
        }
    ).filter(F.col("_before").isNull() | (F.col("itemprice") != F.col("_before")))
    ended = changes.withColumn("EndDate", F.lead("file_date").over(by_day))
    return ended.select(
        "itemcode",
        F.col("_name").alias("itemname"),
        "itemprice",
        F.col("file_date").alias("StartDate"),
        "EndDate",
        F.col("EndDate").isNull().cast("int").alias("IsActive"),
        "num_reshet",
        "num_snif",
    )


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("IsActive") == 1)


def closed(history: DataFrame) -> DataFrame:
    return history.filter(F.col("IsActive") == 0)


LATE = "an observation is not newer than the active version; use rebuild_entities"


def _one_per_entity(batch: DataFrame) -> DataFrame:
    """The priced batch rows as a struct; the job fails if an entity occurs twice.

    Grouping on the join keys adds no shuffle: the join below reuses its partitioning.
    """
    grouped = priced(batch).groupBy(*ENTITY).agg(
        F.count("*").alias("_n"),
        F.max(F.struct("file_date", "itemprice", "itemname")).alias("_row"),
    )
    checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(
        F.raise_error(F.lit("a batch holds several rows for one entity; use merge_batch"))
    )
    return grouped.select(*ENTITY, checked.alias("n"))


def classify(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Match a one-day batch with the active versions: NEW, OLD, UPDATE or NO_CHANGE.

    Result: the entity, ``o`` (active version or null), ``n`` (batch row or null), ``Action``.
    """
    old = current(history).select(
        *ENTITY, F.struct("itemname", "itemprice", "StartDate", "EndDate", "IsActive").alias("o")
    )
    late = F.col("n.file_date") <= F.col("o.StartDate")
    action = (
        F.when(F.col("o").isNull(), "NEW")
        .when(F.col("n").isNull(), "OLD")
        .when((F.col("n.itemprice") != F.col("o.itemprice")) & late, F.raise_error(F.lit(LATE)))
        .when(F.col("n.itemprice") != F.col("o.itemprice"), "UPDATE")
        .otherwise("NO_CHANGE")
    )
    return _one_per_entity(batch).join(old, ENTITY, "outer").withColumn("Action", action)


def apply_batch(history: DataFrame, batch: DataFrame) -> DataFrame:
    """History after a one-day batch, each row labelled with what the batch did to it.

    The join feeds one projection that emits one row, or two for an UPDATE, so it runs once.
    Absence from the batch never closes a version.
    """

    def version(name, price, start, end, active, label):
        return F.struct(
            name.alias("itemname"),
            price.alias("itemprice"),
            start.alias("StartDate"),
            end.alias("EndDate"),
            active.cast("int").alias("IsActive"),
            label.alias("Action"),
        )

    o, n, label = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}")), F.col("Action")
    no_end = F.lit(None).cast("date")
    opened = version(n("itemname"), n("itemprice"), n("file_date"), no_end, F.lit(1), label)
    kept = version(o("itemname"), o("itemprice"), o("StartDate"), o("EndDate"), o("IsActive"), label)
    ended = version(o("itemname"), o("itemprice"), o("StartDate"), n("file_date"), F.lit(0), label)
    reopened = version(
        o("itemname"), n("itemprice"), n("file_date"), no_end, F.lit(1), F.lit("UPDATE-open")
    )
    rows = (
        F.when(label == "NEW", F.array(opened))
        .when(label == "UPDATE", F.array(ended, reopened))
        .otherwise(F.array(kept))
    )
    columns = [*SCD, "Action"]
    touched = classify(history, batch).select(*ENTITY, F.inline(rows)).select(*columns)
    return touched.unionByName(closed(history).withColumn("Action", F.lit("close")).select(*columns))


def advance(active: DataFrame, daily: DataFrame) -> DataFrame:
    """Versions that follow from the active ones and newer daily observations.

    An active version stands for the whole past of its entity: taken as an observation on its
    start day, it makes the one-pass build continue where it ended. Closed versions are not read.
    The job fails if an observation would change something before or on that day. The check looks
    at the same window groups as the build and adds no shuffle.
    """
    columns = [*ENTITY, "itemname", "itemprice", "file_date"]
    seeds = active.select(*ENTITY, "itemname", "itemprice", F.col("StartDate").alias("file_date"))
    both = seeds.withColumn("_seed", F.struct("file_date", "itemprice")).unionByName(
        daily.select(*columns), allowMissingColumns=True
    )
    # Ordered like the build's windows, so that one sort serves all of them.
    whole = Window.partitionBy(*ENTITY).orderBy("file_date").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    known = both.withColumn("_known", F.max("_seed").over(whole))
    late = (F.col("file_date") < F.col("_known.file_date")) | (
        (F.col("file_date") == F.col("_known.file_date")) & (F.col("itemprice") != F.col("_known.itemprice"))
    )
    checked = known.filter(F.when(late, F.raise_error(F.lit(LATE)).cast("boolean")).otherwise(True))
    # What repeats the start of the active version is already in it, under its first name.
    new = F.col("_known").isNull() | (F.col("file_date") > F.col("_known.file_date"))
    return build_versions(checked.filter(F.col("_seed").isNotNull() | new).select(*columns))


def merge_batch(history: DataFrame, daily: DataFrame) -> DataFrame:
    """History after a batch of one or more days, all later than what is already known.

    The history does not tell when an unchanged price was last seen. Where deliveries can come out
    of order, keep a log and use ``rebuild_entities``, or the streaming job, which does both.
    """
    return closed(history).select(*SCD).unionByName(advance(current(history), daily))


def last_known_per_day(log: DataFrame) -> DataFrame:
    """Collapse a log of last observations that several batches contributed to."""
    order = [F.desc("observed_at"), F.desc("file_name"), F.desc("itemprice"), F.desc("itemname")]
    return priced(latest_per(log, [*ENTITY, "file_date"], order))


def rebuild_entities(history: DataFrame, log: DataFrame, late: DataFrame) -> DataFrame:
    """History after late observations: only the entities they touch are built anew from the log."""
    touched = late.select(*ENTITY).distinct()
    evidence = log.select(*DAILY).unionByName(late.select(*DAILY)).join(touched, ENTITY, "left_semi")
    rebuilt = build_versions(last_known_per_day(evidence))
    untouched = history.select(*SCD).join(touched, ENTITY, "left_anti")
    return untouched.unionByName(rebuilt)
