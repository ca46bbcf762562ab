import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.sinks import compaction
from shelfwatch.sinks.compaction import compact, expire, read_snapshot, snapshot_files, take_snapshot
from shelfwatch.sinks.tables import matching_paths
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("day", T.IntegerType())])
TARGET = 20_000


def fill(spark, root, first=0, files=12):
    """Many small files, of which one day has most."""
    day = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).cast("int")
    df = spark.range(first, first + 600, 1, files).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"), day.alias("day"))
    df.write.mode("append").partitionBy("day").parquet(root)


def test_rows_stay_and_files_get_fewer(spark, folder):
    fill(spark, folder)
    assert take_snapshot(spark, folder) == 1
    before, n = rows(read_snapshot(spark, folder, SCHEMA)), snapshot_files(spark, folder).count()
    assert compact(spark, folder, SCHEMA, ["day"], TARGET) == 2
    files = snapshot_files(spark, folder)
    assert rows(read_snapshot(spark, folder, SCHEMA)) == before and files.count() < n / 2
    assert files.agg(F.max("bytes")).first()[0] < 2.5 * TARGET
    assert files.groupBy("folder").count().count() == 5
    # Readers of the old snapshot still find all its files.
    assert rows(read_snapshot(spark, folder, SCHEMA, 1)) == before
    assert compact(spark, folder, SCHEMA, ["day"], 100) == 2  # nothing is small
    assert expire(spark, folder) == [1] and expire(spark, folder) == []
    assert rows(read_snapshot(spark, folder, SCHEMA)) == before
    assert rows(spark.read.schema(SCHEMA).parquet(folder)) == before  # nothing else is left
    with pytest.raises(ValueError, match="no snapshot 1"):
        read_snapshot(spark, folder, SCHEMA, 1)


def test_new_files_come_in_with_the_next_snapshot(spark, folder, monkeypatch):
    monkeypatch.setattr(compaction, "FILES_PER_PART", 5)
    fill(spark, folder)
    take_snapshot(spark, folder)
    compact(spark, folder, SCHEMA, ["day"], TARGET)
    fill(spark, folder, 600)
    assert read_snapshot(spark, folder, SCHEMA).count() == 600
    assert take_snapshot(spark, folder) == 3  # replaced files are still there, and not part of it
    assert read_snapshot(spark, folder, SCHEMA).count() == 1200
    assert compact(spark, folder, SCHEMA, ["day"], TARGET) == 4
    assert rows(read_snapshot(spark, folder, SCHEMA), "id") == sorted(((n,) for n in range(1200)), key=repr)
    assert expire(spark, folder, keep=2) == [1, 2]
    assert read_snapshot(spark, folder, SCHEMA, 3).count() == 1200


def test_a_lost_compaction_leaves_the_snapshot_as_it_was(spark, folder, monkeypatch):
    fill(spark, folder)
    take_snapshot(spark, folder)
    real = compaction.write_once
    with monkeypatch.context() as m:
        m.setattr(compaction, "write_once", lambda df, path: real(df, path) if "groups" in path else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact(spark, folder, SCHEMA, ["day"], TARGET)
    assert matching_paths(spark, f"{folder}/day=1/compacted-*")
    assert read_snapshot(spark, folder, SCHEMA).count() == 600
    assert compact(spark, folder, SCHEMA, ["day"], TARGET) == 2 and read_snapshot(spark, folder, SCHEMA).count() == 600
    assert take_snapshot(spark, folder) == 3 and read_snapshot(spark, folder, SCHEMA).count() == 600


def test_empty_table(spark, folder):
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    take_snapshot(spark, folder)
    assert read_snapshot(spark, folder, SCHEMA).count() == 0
    assert compact(spark, folder, SCHEMA, [], TARGET) == 1
