"""Which delivered files are new, and in which bounded batches they are taken.

Layout under the root:

* ``names/batch=N``       the files of a batch, written before anything of it is done
* ``filter/version=V``    what rules out names that no batch has had, see ``operators.bloom``; version V
  knows of all batches before V

A batch is planned first and done after; whoever does it tells when it is finished. A batch that was
planned and lost is done again with the same files under the same number. So nothing has to remember
every file in memory: a new listing is held against the filter, and only names the filter cannot rule
out meet the names of earlier batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.operators import bloom
from shelfwatch.sinks.tables import (
    current_version,
    delete_path,
    partition_values,
    path_exists,
    prune_versions,
    write_once,
    write_partitioned,
)

MAX_BYTES = 64 * 1024**3
MAX_FILES = 10_000
NAMES_PER_PART = 100_000
_NAMES = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("batch", T.IntegerType())]
)
_FILTER = T.StructType([T.StructField("blocks", T.LongType()), T.StructField("_block", T.LongType()), *[T.StructField(n, T.LongType()) for n in bloom.WORDS]])


def planned(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(b) for b in partition_values(spark, f"{root}/names", "batch"))


def names(spark: SparkSession, root: str, batches: list[int] | None = None) -> DataFrame:
    """The files of all planned batches, or of some."""
    path = f"{root}/names"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _NAMES)
    paths = [path] if batches is None else [f"{path}/batch={b}" for b in batches]
    return spark.read.schema(_NAMES).option("basePath", path).parquet(*paths)


# ---- filter -------------------------------------------------------------------------------------


def _refresh(spark: SparkSession, root: str) -> tuple[DataFrame, int] | None:
    """The filter over all planned batches: the last one and what was planned since, or a larger one made anew."""
    batches = planned(spark, root)
    if not batches:
        return None
    version, wanted = current_version(spark, f"{root}/filter"), batches[-1] + 1
    stored = spark.read.schema(_FILTER)
    before = stored.parquet(f"{root}/filter/version={version}") if version else None
    blocks = before.first().blocks if version else 0
    if version != wanted:
        needed = bloom.blocks_for(names(spark, root).count())  # the counts are in the files' footers
        if blocks < needed:
            made, blocks = bloom.filter_of(names(spark, root), "path", needed), needed
        else:
            since = names(spark, root, [b for b in batches if b >= version])
            made = bloom.merged(before.drop("blocks").unionByName(bloom.filter_of(since, "path", blocks)))
        write_once(made.withColumn("blocks", F.lit(blocks).cast("long")), f"{root}/filter/version={wanted}")
        prune_versions(spark, f"{root}/filter")
    return stored.parquet(f"{root}/filter/version={wanted}").drop("blocks"), blocks


def unseen(listing: DataFrame, root: str) -> DataFrame:
    """The listed files that no planned batch has, by ``path``; exact, whatever the filter lets pass.

    What the filter said is kept under the root until the next plan.
    """
    spark = listing.sparkSession
    found = _refresh(spark, root)
    if found is None:
        return listing
    write_once(bloom.split(listing, "path", *found), f"{root}/asked")
    asked = spark.read.parquet(f"{root}/asked")
    # Known names are looked for among those the filter could not rule out, and of the known ones only
    # those are moved that a filter of these lets pass.
    maybe = asked.filter("maybe").select("path")
    blocks = bloom.blocks_for(maybe.count())
    known = bloom.split(names(spark, root).select("path"), "path", bloom.filter_of(maybe, "path", blocks), blocks)
    known = known.filter("maybe").select("path", F.lit(True).alias("_known")).distinct()
    return asked.join(known, "path", "left").filter(F.col("_known").isNull()).drop("_known", "maybe")


# ---- batches ------------------------------------------------------------------------------------


def plan(listing: DataFrame, root: str, max_bytes: int = MAX_BYTES, max_files: int = MAX_FILES) -> dict:
    """Plan batches for all listed files that are new (``path``, ``length``); returns the backlog they make up.

    A batch has at most ``max_files`` files and ends with the file that reaches ``max_bytes``. The
    running sums behind that are taken in parts, whose totals are added up first.
    """
    spark = listing.sparkSession
    batches = planned(spark, root)
    first = max(batches, default=-1) + 1
    listed, staged = f"{root}/listed", f"{root}/new"
    # Written, as what is decided from one look must not change with the next.
    write_once(listing.select("path", "length").dropDuplicates(["path"]), listed)
    stored = spark.read.schema(T.StructType(_NAMES.fields[:2]))
    write_once(unseen(stored.parquet(listed), root), staged)
    new = stored.parquet(staged)
    backlog = new.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first().asDict()
    if backlog["files"]:
        parts = -(-backlog["files"] // NAMES_PER_PART)
        new = new.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(parts)))
        totals = new.groupBy("part").agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per NAMES_PER_PART files
        totals = totals.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "files")])
        so_far = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        placed = new.join(totals, "part").select(
            "path", "length",
            F.floor((F.col("bytes_before") + F.coalesce(F.sum("length").over(so_far), F.lit(0))) / max_bytes).alias("by_bytes"),
            F.floor((F.col("files_before") + F.count("*").over(so_far)) / max_files).alias("by_files"),
        )
        # A new batch begins wherever either count goes on.
        turns = placed.select("by_bytes", "by_files").distinct()
        turns = turns.withColumn("batch", (F.row_number().over(Window.orderBy("by_files", "by_bytes")) - 1 + first).cast("int"))
        placed = placed.join(turns, ["by_bytes", "by_files"]).select("path", "length", "batch")
        # A batch's directory comes whole or not at all; what a lost plan left out is new to the next one.
        write_partitioned(placed, f"{root}/names", ["batch"])
    for done in (listed, staged, f"{root}/asked"):
        delete_path(spark, done)
    return backlog


def pending(spark: SparkSession, root: str, finished: list[int]) -> list[int]:
    """Planned batches that nobody has finished, oldest first."""
    return [b for b in planned(spark, root) if b not in set(finished)]
