import datetime as dt

from pyspark.sql import functions as F

from shelfwatch.operators import dedup, manifest
from shelfwatch.operators.coverage import missing_days
from shelfwatch.operators.lookup import attach, hot_keys, measured_bytes
from shelfwatch.plans.enrich import join_chain, store_dimension
from tests.conftest import day, rows, stamp


def hot_facts(spark):
    """A third of the rows on one key, some without a key."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 7, None).otherwise(F.col("id") % 20)
    return spark.range(3000).select("id", key.cast("long").alias("k"))


def test_salted_lookup_equals_broadcast(spark):
    facts = hot_facts(spark)
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(15)], "k long, name string")
    small = attach(facts, dim, ["k"], ["id"])
    large = attach(facts, dim, ["k"], ["id"], max_bytes=0)
    assert rows(small, "id", "k", "name") == rows(large, "id", "k", "name")
    plan = large._jdf.queryExecution().sparkPlan().toString()
    assert "_salt" in plan and "BroadcastHash" in small._jdf.queryExecution().sparkPlan().toString()


def test_only_measured_hot_keys_are_repeated(spark):
    facts = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("long").alias("k"), F.lit("c").alias("c"))
    hashed = facts.filter("k = 1").select(F.xxhash64("k", "c").alias("h")).first().h
    assert hot_keys(facts, ["k", "c"]) == [hashed]
    dim = spark.range(20_000).select(F.col("id").alias("k"), F.lit("c").alias("c"), F.concat(F.lit("n"), "id").alias("name"))
    joined = attach(facts, dim, ["k", "c"], ["id"], max_bytes=0)
    assert joined.filter("name = concat('n', k)").count() == joined.filter("k < 20000").count() and joined.count() == 30_000
    # The hot key's rows lie in several join partitions, and so in several tasks.
    salted = joined.filter("k = 1").select(F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = attach(facts, dim.filter("k > 1"), ["k", "c"], ["id"], max_bytes=0).filter("k = 1")
        assert plain.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert salted.count() == 10_001  # and the row of its own number
    assert hot_keys(facts.filter("k != 1"), ["k"]) == [] and hot_keys(facts.limit(0), ["k"]) == []


def test_salted_lookup_keeps_repeated_dimension_rows(spark):
    facts = hot_facts(spark)
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, name string")
    assert rows(attach(facts, dim, ["k"], ["id"]), "id", "name") == rows(
        attach(facts, dim, ["k"], ["id"], max_bytes=0), "id", "name"
    )


def test_a_large_source_of_a_small_dimension_does_not_prevent_the_broadcast(spark):
    dim = spark.createDataFrame([(1, "a")], "k long, name string")
    source = spark.range(5000).select(F.lit(1).alias("k"), F.lit("a").alias("name"))
    joined = attach(hot_facts(spark), dim, ["k"], ["id"], max_bytes=1000, derived_from=source)
    assert "BroadcastHash" in joined._jdf.queryExecution().sparkPlan().toString()
    assert "_salt" not in joined.columns


def test_measured_bytes_grows_with_rows(spark):
    dim = spark.range(1000).select("id", F.lit("x" * 100).alias("t"))
    assert 1000 * 100 < measured_bytes(dim) < 1000 * 200
    assert measured_bytes(dim.limit(0)) == 0


def test_chain_keys_that_are_no_numbers_match_nothing(spark):
    prices = spark.createDataFrame([("07x", "1", "f"), ("7", "1", "f"), (None, "1", "f")], "num_reshet string, itemcode string, file_name string")
    chains = spark.createDataFrame([(7, "seven")], "reshet_num long, reshet_name string")
    assert rows(join_chain(prices, chains), "num_reshet", "reshet_name") == [
        ("07x", None),
        ("7", "seven"),
        (None, None),
    ]


PRICE = "itemcode string, num_reshet string, num_snif string, itemname string, itemprice string, file_name string, file_date timestamp"


def test_latest_per_day_is_decided_on_ties(spark):
    given = [
        ("1", "7", "1", "a", "5", "f1", stamp(0, 3)),
        ("1", "7", "1", "b", "6", "f2", stamp(0, 9)),
        ("1", "7", "1", "c", "7", "f3", stamp(0, 9)),
        ("1", "7", "1", "d", "8", "f1", stamp(1, 3)),
    ]
    for order in (given, given[::-1]):
        df = spark.createDataFrame(order, PRICE).repartition(4)
        assert rows(dedup.latest_per_day(df), "itemname") == [("c",), ("d",)]


def test_hot_group_is_collapsed_before_the_shuffle(spark):
    text = (F.col("id") % 2).cast("string")
    names = ("itemcode", "num_reshet", "num_snif", "itemname", "itemprice", "file_name")
    df = spark.range(100).select(*[text.alias(c) for c in names], F.timestamp_seconds("id").alias("file_date"))
    plan = dedup.latest_per_day(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_one_store_row_per_key(spark):
    given = [
        ("7", "001", "s", "old", "c", "1", "f1", stamp(0)),
        ("7", "1", "s", "new", "c", "1", "f2", stamp(1)),
        ("8", "1", "t", None, "c", None, "f1", stamp(0)),
        ("8", "x", "t", None, "c", None, "f1", stamp(0)),
    ]
    df = spark.createDataFrame(given, "num_reshet string, storeid string, storename string, address string, city string, zipcode string, file_name string, file_date timestamp")
    assert rows(store_dimension(df), "num_reshet", "num_snif", "address") == [("7", 1, "new"), ("8", 1, None)]


def test_new_files_and_duplicates(spark):
    found = spark.createDataFrame([("Price1-1-1.gz",), ("Price1-1-1.gz",), ("Stores1-1.xml",), ("Price2-1-1.gz",)], "file_name string")
    landed = spark.createDataFrame([("Price1-1-1.parquet",)], "landed_name string")
    assert rows(manifest.new_files(found, landed), "file_name", "target") == [("Price2-1-1.gz", "prices"), ("Stores1-1.xml", "snifim")]
    assert rows(manifest.duplicate_names(found)) == [(4, 3, 1)]


def test_object_listing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("PriceA.gz", "StoresB.xml"):
        (tmp_path / "in" / name).write_text("x" * 10)
    listing = manifest.object_listing(spark, str(tmp_path), "Price*")
    assert [(r.path.split("/")[-1], r.length) for r in listing.collect()] == [("PriceA.gz", 10)]


def test_missing_days_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    expected = [(k,) for k in "abcd"]
    delivered = [(rng.choice("abcx"), day(rng.randrange(-3, 25))) for _ in range(60)] * 3
    got = rows(
        missing_days(
            spark.createDataFrame(expected, "k string"),
            spark.createDataFrame(delivered, "k string, d date"),
            ["k"], "d", F.lit(day(0)), F.lit(day(20)),
        )
    )
    want = [(k, day(n)) for (k,) in expected for n in range(21) if (k, day(n)) not in set(delivered)]
    assert got == sorted(want, key=repr)
    assert isinstance(got[0][1], dt.date)
