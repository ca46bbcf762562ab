from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import lifecycle
from shelfwatch.plans import history
from shelfwatch.session import fresh_dir, shared_dir
from shelfwatch.sinks import jdbc as jdbc_sink
from shelfwatch.sinks import tables
from shelfwatch.sources import jdbc as jdbc_source
from shelfwatch.sources import messages as message_source
from shelfwatch.sources.schemas import SCD
from tests.conftest import day, rows, stamp


def daily_rows(spark, days=12, per_day=4):
    rows_ = [(i, day(n)) for n in range(days) for i in range(per_day)] + [(99, None)]
    return spark.createDataFrame(rows_, "i int, snapshot date")


def test_retention_keeps_rows_without_a_day_and_drops_the_cutoff_day(spark):
    df = daily_rows(spark)
    today = F.lit(day(11))
    kept = {r[1] for r in lifecycle.keep(df, today).collect()}
    assert kept == {None, *(day(n) for n in range(5, 12))}
    assert {r[1] for r in lifecycle.expired(df, today).collect()} == {day(n) for n in range(5)}
    assert rows(lifecycle.retention_metrics(df, today)) == [(49, 20, 29)]


def test_partition_write_can_be_repeated(spark, folder):
    df = daily_rows(spark)
    for _ in range(2):
        tables.write_partitioned(df, folder, ["snapshot"])
    tables.write_partitioned(df.filter(F.col("snapshot") == day(3)).withColumn("i", F.lit(7)), folder, ["snapshot"])
    got = spark.read.parquet(folder)
    assert got.count() == df.count()
    assert rows(got.filter(F.col("snapshot") == day(3)).select("i")) == [(7,)] * 4


def test_hot_partition_is_written_by_several_tasks(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 400_000, 1, 8).select(
            "id", F.xxhash64("id").alias("v"), F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 5).alias("p")
        )
        tables.write_partitioned(df, folder, ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = spark.read.parquet(folder).filter("p = 0").select(F.input_file_name().alias("f")).distinct().count()
    assert hot > 1 and spark.read.parquet(folder).count() == 400_000


def test_expired_partitions_are_dropped_as_directories(spark, folder):
    tables.write_partitioned(daily_rows(spark), folder, ["snapshot"])
    gone = lifecycle.drop_expired(spark, folder, day(11))
    assert gone == [str(day(n)) for n in range(5)]
    left = {r[0] for r in spark.read.parquet(folder).select("snapshot").collect()}
    assert left == {None, *(day(n) for n in range(5, 12))}


def test_archive_moves_whole_days_and_can_be_repeated(spark, folder):
    live, stored = folder + "/live", folder + "/archive"
    df = daily_rows(spark, days=40)
    tables.write_partitioned(df, live, ["snapshot"])
    assert len(lifecycle.archive(spark, live, stored, day(11))) == 5
    assert lifecycle.archive(spark, live, stored, day(11)) == []
    assert len(lifecycle.archive(spark, live, stored, day(39))) == 28
    both = spark.read.parquet(live).select("i", "snapshot").union(spark.read.parquet(stored).select("i", "snapshot"))
    assert rows(both) == rows(df)
    assert tables.partition_values(spark, stored, "archive_month") == ["2024-01", "2024-02"]


def test_late_files_for_an_archived_day_are_added(spark, folder):
    live, stored = folder + "/live", folder + "/archive"
    df = daily_rows(spark)
    tables.write_partitioned(df, live, ["snapshot"])
    lifecycle.archive(spark, live, stored, day(11))
    late = df.filter(F.col("snapshot") == F.lit(day(1)))
    tables.write_partitioned(late, live, ["snapshot"])
    assert lifecycle.archive(spark, live, stored, day(11)) == [str(day(1))]
    assert lifecycle.archive(spark, live, stored, day(11)) == []
    both = spark.read.parquet(live).select("i", "snapshot").union(spark.read.parquet(stored).select("i", "snapshot"))
    assert rows(both) == rows(df.union(late))


def test_incomplete_archive_keeps_the_originals(spark, folder, monkeypatch):
    live, stored = folder + "/live", folder + "/archive"
    tables.write_partitioned(daily_rows(spark), live, ["snapshot"])
    real = lifecycle.write_partitioned
    monkeypatch.setattr(lifecycle, "write_partitioned", lambda df, path, by: real(df.filter("i <> 1"), path, by))
    with pytest.raises(RuntimeError, match="originals stay"):
        lifecycle.archive(spark, live, stored, day(11))
    assert spark.read.parquet(live).count() == 49


RAW = "itemcode string, num_reshet string, num_snif string, itemname string, itemprice string, file_name string, file_date timestamp"


def test_history_versions_never_overwrite_what_they_read(spark, folder):
    def batch(n, price):
        return spark.createDataFrame([("1", "7", "1", f"n{n}", price, "PriceFull", stamp(n))], RAW)

    assert tables.read_current(spark, folder) is None
    assert history.refresh_history(spark, batch(0, "5"), folder) == 1
    assert history.refresh_history(spark, batch(1, "6"), folder) == 2
    assert history.refresh_history(spark, batch(1, "6"), folder) == 3  # the same batch again
    got = rows(tables.read_current(spark, folder).select(*SCD), "itemname", "StartDate", "EndDate")
    assert got == [("n0", day(0), day(1)), ("n0", day(1), None)]
    tables.delete_path(spark, f"{folder}/version=3/_SUCCESS")  # an unfinished write is not current
    assert tables.current_version(spark, folder) == 2


def test_external_table(spark, folder):
    df = daily_rows(spark)
    tables.write_partitioned(df, folder, ["snapshot"])
    tables.expose_external(spark, "daily_external", folder, df.schema, ["snapshot"])
    got = spark.sql(f"SELECT count(*) AS n FROM daily_external WHERE snapshot = DATE '{day(2)}'").first().n
    assert got == 4
    spark.sql("DROP TABLE daily_external")
    assert spark.read.parquet(folder).count() == 49  # dropping the table keeps the files
    with pytest.raises(ValueError):
        tables.expose_external(spark, "x; DROP", folder, df.schema)


class FakeSession:
    def __init__(self, **conf):
        self.conf = {k.replace("__", "."): v for k, v in conf.items()}


def test_work_folder(spark):
    named = FakeSession(spark__checkpoint__dir="hdfs://shared/x/", spark__master="yarn")
    assert shared_dir(named) == "hdfs://shared/x"
    assert fresh_dir(named, "a") != fresh_dir(named, "a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession(spark__master="yarn"))
    local = FakeSession(spark__master="local[2]")
    assert shared_dir(local) == shared_dir(local)


def options_of(reader):
    """All options given to a mocked reader or writer, in whatever chain of calls."""
    given = {}
    for name, args, kwargs in reader.mock_calls:
        if name.split(".")[-1] == "option":
            given[args[0]] = args[1]
        given.update(kwargs.get("properties", {}))
    return given


def test_relational_tables_are_read_in_parallel_and_replaced_in_place():
    session, df = MagicMock(), MagicMock()
    jdbc_source.read_table(session, "jdbc:x", "dwh.t", "u", "p", split=("num_snif", 0, 1000, 16))
    got = options_of(session)
    assert got["dbtable"] == "dwh.t" and got["numPartitions"] == "16" and got["partitionColumn"] == "num_snif"
    jdbc_sink.append_table(df, "jdbc:x", "dwh.t", "u", "p")
    jdbc_sink.replace_table(df, "jdbc:x", "dwh.t", "u", "p")
    assert options_of(df)["truncate"] == "true"
    assert [c.kwargs["mode"] for c in [*df.write.jdbc.call_args_list, *df.write.option().jdbc.call_args_list]] == [
        "append",
        "overwrite",
    ]


def test_topics_are_read_from_the_start_unless_a_checkpoint_says_otherwise(monkeypatch):
    monkeypatch.setattr(message_source, "F", MagicMock())
    session = MagicMock()
    message_source.kafka_stream(session, "host:1", "prices", max_offsets=500)
    got = options_of(session)
    assert got["subscribe"] == "prices" and got["startingOffsets"] == "earliest"
    assert got["maxOffsetsPerTrigger"] == "500"
