"""Price history kept by a stream, in buckets of stores that are merged when read.

Layout under the root; each directory is written by exactly one batch and never changed after:

* ``log/batch=N/bucket=B``          last observation per entity and day of the batch
* ``versions/rebuilt=false/batch=N``  what the batch changed, by kind and bucket: ``kind=state`` an
  entity's active version, if it has one, and the last day it was seen; ``kind=closed`` versions the
  batch closed; ``kind=late`` entities seen on a day that is not after their last
* ``versions/rebuilt=true/batch=N``   state and closed versions of the late ones, from the log; what
  earlier batches closed of them no longer counts
* ``rejected/batch=N``              rows without a readable key or date, as they came, if there are any
* ``manifest/batch=N``              per bucket the directories that hold its state; written last, so
  it tells that the batch is finished

A batch reads the state of the buckets it touches, and writes what it changes. A bucket whose state
lies in ``MAX_PARTS`` directories is written anew as a whole by the next batch that touches it, so
reading stays bounded. Whether an observation is late is told by the state alone; only late ones
make a batch read the log, and only the buckets they are in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.casts import convert
from shelfwatch.operators import scd2
from shelfwatch.operators.messages import decode
from shelfwatch.sinks.tables import delete_path, matching_paths, partition_values, path_exists, write_once, write_partitioned
from shelfwatch.sources.schemas import ENTITY, PRICE, SCD
from shelfwatch.streaming.consume import Sink

BUCKETS = 64
MAX_PARTS = 6

def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, of) for name, of in types.items()])


_WHOLE, _LONG, _TEXT, _DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
_KEY = {"itemcode": _LONG, "num_reshet": _LONG, "num_snif": _WHOLE}
_LOG = _schema(
    **_KEY, itemname=_TEXT, itemprice=PRICE, observed_at=T.TimestampType(), file_name=_TEXT, file_date=_DATE, batch=_WHOLE, bucket=_WHOLE
)
_ROW = _schema(
    **_KEY, itemname=_TEXT, itemprice=PRICE, StartDate=_DATE, EndDate=_DATE, last_seen=_DATE,
    rebuilt=T.BooleanType(), batch=_WHOLE, kind=_TEXT, bucket=_WHOLE,
)
_MANIFEST = _schema(buckets=_WHOLE, bucket=_WHOLE, parts=T.ArrayType(_TEXT))
_VALUES = ["itemname", "itemprice", "StartDate", "EndDate", "last_seen"]


def bucket_of(buckets: int) -> Column:
    """All items of a store are in one bucket, so a batch touches the buckets of the stores it brings."""
    return F.pmod(F.xxhash64("num_reshet", "num_snif"), F.lit(buckets)).cast("int")


# ---- manifest -----------------------------------------------------------------------------------


def _finished(spark: SparkSession, root: str) -> list[int]:
    batches = map(int, partition_values(spark, f"{root}/manifest", "batch"))
    return sorted(b for b in batches if path_exists(spark, f"{root}/manifest/batch={b}/_SUCCESS"))


def latest_batch(spark: SparkSession, root: str) -> int | None:
    return max(_finished(spark, root), default=None)


def _manifest(spark: SparkSession, root: str, batch: int | None) -> tuple[int | None, dict[int, list[str]]]:
    """The number of buckets, and per bucket that has state its directories, oldest first."""
    if batch is None:
        return None, {}
    # One row per bucket, and one for the number of buckets.
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest/batch={batch}").collect()
    return rows[0].buckets, {r.bucket: list(r.parts) for r in rows if r.parts}


def _read(spark: SparkSession, base: str, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _versions(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    return _read(spark, f"{root}/versions", paths, _ROW)


def _state(spark: SparkSession, root: str, parts: dict[int, list[str]]) -> DataFrame:
    """State rows of the given buckets; an entity may have one per directory."""
    return _versions(spark, root, [f"{root}/versions/{p}/kind=state/bucket={b}" for b, some in parts.items() for p in some])


def _up_to(spark: SparkSession, pattern: str, batch_id: int) -> list[str]:
    """Directories that match, of batches up to the given one."""
    found = matching_paths(spark, pattern)
    return [p for p in found if int(p.rsplit("/batch=", 1)[1].split("/")[0]) <= batch_id]


# ---- reading ------------------------------------------------------------------------------------


def _newest(state: DataFrame) -> DataFrame:
    """One row per entity: what the newest directory says."""
    order = F.struct("batch", "rebuilt", *[c for c in _VALUES if c != "EndDate"])
    return state.groupBy(*ENTITY).agg(F.max(order).alias("s")).select(*ENTITY, "s.itemname", "s.itemprice", "s.StartDate", "s.last_seen")


def read_active(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The active versions as of a finished batch, and the last day each entity was seen."""
    if batch_id not in _finished(spark, root):
        raise ValueError(f"batch {batch_id} was never finished, or its active versions were pruned")
    return _newest(_state(spark, root, _manifest(spark, root, batch_id)[1])).filter(F.col("StartDate").isNotNull())


def read_history(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The whole history as of a finished batch; an unfinished or pruned one is an error."""
    active = read_active(spark, root, batch_id)
    active = active.withColumns({"EndDate": F.lit(None).cast("date"), "IsActive": F.lit(1)})
    parts = f"{root}/versions/rebuilt=*/batch=*"
    closed = _versions(spark, root, _up_to(spark, f"{parts}/kind=closed", batch_id))
    again = _versions(spark, root, _up_to(spark, f"{parts.replace('=*', '=true', 1)}/kind=state", batch_id))
    since = again.groupBy(*ENTITY).agg(F.max("batch").alias("_since"))
    counts = F.col("_since").isNull() | F.when(F.col("rebuilt"), F.col("batch") == F.col("_since")).otherwise(F.col("batch") > F.col("_since"))
    closed = closed.join(since, ENTITY, "left").filter(counts).withColumn("IsActive", F.lit(0))
    return active.select(*SCD).unionByName(closed.select(*SCD))


def prune_active(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Drop state that only batches before the newest ones refer to, and those batches' manifests.

    The history as of a pruned batch can no longer be read; closed versions and the log stay.
    """
    batches = _finished(spark, root)
    kept = batches[-max(keep, 1) :]
    gone = batches[: -len(kept)] if kept else []
    if not gone:
        return []
    used = {f"{p}/kind=state/bucket={b}" for k in kept for b, parts in _manifest(spark, root, k)[1].items() for p in parts}
    for batch in gone:
        delete_path(spark, f"{root}/manifest/batch={batch}")
    for path in _up_to(spark, f"{root}/versions/rebuilt=*/batch=*/kind=state/bucket=*", kept[-1]):
        if "rebuilt=" + path.rsplit("/rebuilt=", 1)[1] not in used:
            delete_path(spark, path)
    return gone


# ---- one batch ----------------------------------------------------------------------------------


def _merged(state: DataFrame, daily: DataFrame, buckets: int, whole: list[int]) -> DataFrame:
    """What a batch changes, from the state of the buckets it touches and its daily observations.

    An entity's state and observations lie on one line; all windows over it share one shuffle and
    one sort. Rows: ``state`` of every observed entity (of every entity in the buckets ``whole``),
    ``closed`` versions, or ``late`` for an entity that needs its log.
    """
    known = F.struct("batch", "rebuilt", "itemname", "itemprice", "StartDate", "last_seen").alias("_state")
    line = state.select(*ENTITY, known).unionByName(
        daily.select(*ENTITY, "itemname", "itemprice", "file_date"), allowMissingColumns=True
    )
    # The state comes first: it has no day of its own on the line.
    in_order = Window.partitionBy(*ENTITY).orderBy(F.col("file_date").asc_nulls_first())
    all_rows = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    line = line.withColumns({"_known": F.max("_state").over(all_rows), "_n": F.row_number().over(in_order)})
    line = line.filter(F.col("_state").isNull() | (F.col("_n") == 1))
    is_state = F.col("_state").isNotNull()
    line = line.withColumns(
        {
            "_day": F.when(is_state, F.col("_known.StartDate")).otherwise(F.col("file_date")),
            "_price": F.when(is_state, F.col("_known.itemprice")).otherwise(F.col("itemprice")),
            "_name": F.when(is_state, F.col("_known.itemname")).otherwise(F.col("itemname")),
            "_late": F.coalesce(F.bool_or(F.col("file_date") <= F.col("_known.last_seen")).over(all_rows), F.lit(False)),
            "_seen": F.max("file_date").over(all_rows),
        }
    )
    before = F.last("_price", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    line = line.withColumn("_change", F.col("_price").isNotNull() & (before.isNull() | (F.col("_price") != before)))
    change_day = F.when(F.col("_change"), F.col("_day"))
    line = line.withColumns(
        {
            "_next": F.min(change_day).over(in_order.rowsBetween(1, Window.unboundedFollowing)),
            "_first": F.first(F.when(F.col("_price").isNotNull(), F.struct("_name")), ignorenulls=True).over(all_rows),
            "_active": F.max(F.when(F.col("_change"), F.struct("_day", "_price"))).over(all_rows),
        }
    )
    no_day = F.lit(None).cast("date")
    name = F.col("_first._name")

    def row(kind: str, price: Column, start: Column, end: Column, seen: Column) -> Column:
        values = zip(_VALUES, (name, price, start, end, seen))
        return F.struct(F.lit(kind).alias("kind"), *[v.alias(c) for c, v in values])

    first, late = F.col("_n") == 1, F.col("_late")
    seen = F.greatest("_known.last_seen", "_seen")
    written = F.col("_seen").isNotNull()
    if whole:
        written = written | bucket_of(buckets).isin(whole)
    rows = F.array(
        F.when(first & late, row("late", F.lit(None).cast(PRICE), no_day, no_day, no_day)),
        F.when(first & ~late & written, row("state", F.col("_active._price"), F.col("_active._day"), no_day, seen)),
        F.when(~late & F.col("_change") & F.col("_next").isNotNull(), row("closed", F.col("_price"), F.col("_day"), F.col("_next"), no_day)),
    )
    return line.select(*ENTITY, F.inline(F.array_compact(rows))).withColumn("bucket", bucket_of(buckets))


def _rebuilt(log: DataFrame, late: DataFrame, buckets: int) -> DataFrame:
    """State and closed versions of late entities, from all that was ever observed of them."""
    evidence = log.join(late.select(*ENTITY), ENTITY, "left_semi")
    versions = scd2.build_versions(scd2.last_known_per_day(evidence))
    seen = evidence.groupBy(*ENTITY).agg(F.max("file_date").alias("last_seen"))
    state = seen.join(versions.filter("IsActive = 1"), ENTITY, "left").withColumn("kind", F.lit("state"))
    closed = versions.filter("IsActive = 0").withColumns({"kind": F.lit("closed"), "last_seen": F.lit(None).cast("date")})
    columns = [*ENTITY, "kind", *_VALUES]
    return state.select(*columns).unionByName(closed.select(*columns)).withColumn("bucket", bucket_of(buckets))


def _observe(spark: SparkSession, chosen: DataFrame, root: str, batch_id: int, buckets: int) -> None:
    """Log the batch's last observations; rejected rows are looked for only if the same job met some."""
    met = Observation()
    keys = [convert(F.col(c), t).isNull() for c, t in scd2.OBSERVED_TYPES.items() if c != "itemprice"]
    bad = F.col("file_date").isNull()
    for k in keys:
        bad = bad | k
    observed = scd2.last_observations(chosen.observe(met, F.count_if(bad).alias("rejected")))
    rows = observed.select(*[c for c in _LOG.names if c not in ("batch", "bucket")]).withColumn("bucket", bucket_of(buckets))
    write_partitioned(rows, f"{root}/log/batch={batch_id}", ["bucket"])
    if met.get["rejected"]:
        write_once(scd2.rejected_observations(chosen), f"{root}/rejected/batch={batch_id}")


def continue_history(prices: DataFrame, batch_id: int, root: str, chain: str | None = None, buckets: int = BUCKETS) -> None:
    """Continue the history by one batch of raw prices; repeating the batch changes nothing."""
    spark = prices.sparkSession
    finished = _finished(spark, root)
    if batch_id in finished:
        return
    known, parts = _manifest(spark, root, max((b for b in finished if b < batch_id), default=None))
    buckets = known or buckets
    log, new, again = f"{root}/log/batch={batch_id}", *(f"rebuilt={r}/batch={batch_id}" for r in ("false", "true"))
    for left in (log, f"{root}/versions/{new}", f"{root}/versions/{again}"):
        delete_path(spark, left)  # by an attempt that was lost
    _observe(spark, scd2.full_files(prices, chain=chain), root, batch_id, buckets)

    touched = [int(b) for b in partition_values(spark, log, "bucket")]
    if touched:
        whole = [b for b in touched if len(parts.get(b, [])) >= MAX_PARTS]
        state = _state(spark, root, {b: parts[b] for b in touched if b in parts})
        changed = _merged(state, _read(spark, f"{root}/log", [log], _LOG), buckets, whole)
        write_partitioned(changed, f"{root}/versions/{new}", ["kind", "bucket"])
        for b in map(int, partition_values(spark, f"{root}/versions/{new}/kind=state", "bucket")):
            parts[b] = [*([] if b in whole else parts.get(b, [])), new]
        late_in = partition_values(spark, f"{root}/versions/{new}/kind=late", "bucket")
        if late_in:
            late = _versions(spark, root, [f"{root}/versions/{new}/kind=late"])
            logs = [p for b in late_in for p in _up_to(spark, f"{root}/log/batch=*/bucket={b}", batch_id)]
            rebuilt = _rebuilt(_read(spark, f"{root}/log", logs, _LOG), late, buckets)
            write_partitioned(rebuilt, f"{root}/versions/{again}", ["kind", "bucket"])
            for b in map(int, late_in):
                parts[b] = [*parts.get(b, []), again]
    rows = [(buckets, None, None), *((buckets, b, p) for b, p in sorted(parts.items()))]
    write_once(spark.createDataFrame(rows, _MANIFEST).coalesce(1), f"{root}/manifest/batch={batch_id}")


def history_sink(schema: T.StructType | None, root: str, chain: str | None = None, buckets: int = BUCKETS) -> Sink:
    """Keep the history under ``root``; without a schema the rows come parsed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        prices = decode(batch, schema, keep=[]) if schema else batch
        continue_history(prices, batch_id, root, chain, buckets)

    return write
