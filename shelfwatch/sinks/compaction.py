"""Fewer, larger files behind a pointer, so that whoever reads an older snapshot is not disturbed.

A snapshot is a list of files with their sizes, kept as ``_snapshots/version=N`` beside the data and
written last. Compaction packs the small files of each partition directory into groups of about the
target size, writes each group as one file, and publishes the next snapshot, in which these stand for
the files they were made of. Replaced files stay until ``expire`` drops the snapshots that name them.

Tables that are compacted are read by snapshot; a plain scan of the folder would meet rows twice in
the meantime. There is one writer of snapshots at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.operators import lookup
from shelfwatch.sinks.tables import (
    current_version,
    delete_path,
    finished_versions,
    matching_paths,
    move_path,
    partition_values,
    path_exists,
    write_once,
)

TARGET_BYTES = 256 * 1024 * 1024
# Files below this share of the target are packed.
SMALL = 0.75
FILES_PER_PART = 10_000
MADE = "compacted-"

_FILES = T.StructType([T.StructField(n, t) for n, t in (("path", T.StringType()), ("folder", T.StringType()), ("bytes", T.LongType()))])


def _snapshots(root: str) -> str:
    return f"{root}/_snapshots"


def _listing(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """The data files below the root and the folder each is in; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    files = found.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("length").alias("bytes"))
    # Folders that begin with an underscore hold no data, as everywhere in Spark.
    return files.filter(~F.col("folder").rlike("/_[^/=]*(/|$)"))


def take_snapshot(spark: SparkSession, root: str) -> int:
    """Make the files that are there now the table's snapshot, but for those a lost compaction has left."""
    version = (current_version(spark, _snapshots(root)) or 0) + 1
    files = _listing(spark, root)
    ours = F.element_at(F.split("path", "/"), -1).startswith(MADE)
    if version > 1:
        known = snapshot_files(spark, root).select("path", F.lit(True).alias("known"))
        files = files.join(known, "path", "left").filter(~ours | F.col("known")).drop("known")
        # What the newest snapshot has replaced is still there, but no longer part of the table.
        files = files.join(_replaced(spark, root), "path", "left_anti")
    write_once(files.select(*_FILES.names), f"{_snapshots(root)}/version={version}")
    return version


def _replaced(spark: SparkSession, root: str) -> DataFrame:
    """Files that some earlier snapshot has and the newest one has not."""
    every = spark.read.schema(_FILES).parquet(*[f"{_snapshots(root)}/version={v}" for v in finished_versions(spark, _snapshots(root))])
    return every.select("path").distinct().join(snapshot_files(spark, root).select("path"), "path", "left_anti")


def snapshot_files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """path, folder, bytes of a snapshot's files; the newest snapshot unless one is named."""
    version = version or current_version(spark, _snapshots(root))
    if version is None or not path_exists(spark, f"{_snapshots(root)}/version={version}/_SUCCESS"):
        raise ValueError(f"{root} has no snapshot {version}")
    return spark.read.schema(_FILES).parquet(f"{_snapshots(root)}/version={version}")


def _rows(spark: SparkSession, root: str, schema: T.StructType, files: DataFrame) -> DataFrame:
    paths = [r.path for r in files.select("path").collect()]  # the plan of a scan names its files
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    return _rows(spark, root, schema, snapshot_files(spark, root, version))


def _groups(files: DataFrame, target: int) -> DataFrame:
    """path, folder and group of the files to be packed: neighbours by name up to the target, two or more of them."""
    small = files.filter(F.col("bytes") < SMALL * target)
    counts = small.groupBy("folder").agg(F.ceil(F.count("*") / FILES_PER_PART).alias("parts"))
    # A folder with very many files is packed in parts.
    small = small.join(counts, "folder").withColumn("part", F.pmod(F.xxhash64("path"), F.col("parts")))
    before = Window.partitionBy("folder", "part").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target)
    named = small.withColumn("number", number).withColumn("group", F.sha1(F.concat_ws("/", "folder", "part", "number")))
    several = named.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1").select("group")
    return named.join(several, "group").select("path", "folder", "group")


def compact(spark: SparkSession, root: str, schema: T.StructType, partitioned_by: list[str], target: int = TARGET_BYTES) -> int:
    """Pack the newest snapshot's small files; returns the snapshot that holds from then on."""
    version = current_version(spark, _snapshots(root))
    files = snapshot_files(spark, root)
    run = uuid.uuid4().hex
    work = f"{root}/_compacting-{run}"
    write_once(_groups(files, target), f"{work}/groups")
    groups = spark.read.parquet(f"{work}/groups")
    if groups.isEmpty():
        delete_path(spark, work)
        return version
    of_file = groups.select(F.col("path").alias("_path"), F.col("group").alias("_group"))
    of_file = F.broadcast(of_file) if lookup.measured_bytes(of_file) <= lookup.BROADCAST_BYTES else of_file
    rows = _rows(spark, root, schema, groups).withColumn("_path", F.col("_metadata.file_path")).join(of_file, "_path")
    rows = rows.drop("_path", *partitioned_by)
    rows.repartition("_group").write.partitionBy("_group").parquet(f"{work}/rows")

    folder = {r["group"]: r.folder for r in groups.select("group", "folder").distinct().collect()}  # one row per file made
    for group in partition_values(spark, f"{work}/rows", "_group"):
        for n, made in enumerate(matching_paths(spark, f"{work}/rows/_group={group}/part-*")):
            move_path(spark, made, f"{folder[group]}/{MADE}{run}-{group}-{n}.parquet")
    new = _listing(spark, root, f"{MADE}{run}-*.parquet")
    kept = files.join(groups.select("path"), "path", "left_anti")
    write_once(kept.select(*_FILES.names).unionByName(new.select(*_FILES.names)), f"{_snapshots(root)}/version={version + 1}")
    delete_path(spark, work)
    return version + 1


def expire(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Drop all snapshots but the newest ones, and the files that only those have."""
    versions = finished_versions(spark, _snapshots(root))
    gone, kept = versions[: -max(keep, 1)], versions[-max(keep, 1) :]
    if not gone:
        return []
    some = lambda which: spark.read.schema(_FILES).parquet(*[f"{_snapshots(root)}/version={v}" for v in which]).select("path").distinct()
    for r in some(gone).join(some(kept), "path", "left_anti").toLocalIterator():
        delete_path(spark, r.path)
    for v in gone:
        delete_path(spark, f"{_snapshots(root)}/version={v}")
    return gone
