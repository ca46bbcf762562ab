import datetime as dt
import gzip
import os
import shutil

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators.contract import BrokenContract, Limits, Measured
from shelfwatch.operators.messages import progress
from shelfwatch.plans import catalog, daily
from shelfwatch.sinks import tables
from shelfwatch.sources.schemas import RAW_STORE
from shelfwatch.streaming import landing, outbox
from shelfwatch.streaming.consume import run_available
from tests.conftest import day, rows
from tests.test_sources import put
from tests.test_streaming import price_document

BY, ORDER = ["num_reshet", "num_snif"], ["file_name", "itemcode"]
PRICE_ROW = "itemcode string, num_reshet string, num_snif string, itemprice string, file_name string"


def places_of(folder):
    return daily.Places(f"{folder}/in/prices", f"{folder}/in/stores", f"{folder}/tables")


def chains_of(spark):
    return spark.createDataFrame([("Chain", 7290)], "reshet_name string, reshet_num long")


def store_document(n, addresses, chain="7290"):
    """(store, address) as one UTF-16 document."""
    ids = [f"<StoreId>{i}</StoreId>" if i else "" for i, _ in addresses]
    stores = "".join(f"<Store>{i}<StoreName>s</StoreName><Address>{a}</Address></Store>" for i, (_, a) in zip(ids, addresses))
    name = f"Stores{chain}-{day(n):%Y%m%d}0600.xml"
    text = f'<?xml version="1.0" encoding="UTF-16"?><Root><Stores>{stores}</Stores></Root>'
    return name, text.encode("utf-16")


def sent(n, store="1", items=3):
    return [(str(i), "7290", store, str(n), f"Price7290-{store}-{n:04}") for i in range(items)]


# ---- publication --------------------------------------------------------------------------------


def test_offsets_go_on_without_gaps_and_a_publication_is_made_once(spark, folder, monkeypatch):
    monkeypatch.setattr(outbox, "ROWS_PER_PART", 7)
    log = f"{folder}/log"
    given = [sent(0, "1", 50) + sent(0, "2", 1), [], sent(1, "1", 4) + sent(1, "3", 20) + sent(1, "3", 20)]
    for n, batch in enumerate(given):
        df = spark.createDataFrame(batch, PRICE_ROW)
        assert outbox.publish(df, "prices", log, n, BY, ORDER, partitions=3)
        assert not outbox.publish(df, "prices", log, n, BY, ORDER, partitions=3)
    found = spark.read.parquet(log)
    assert found.count() == sum(map(len, given))
    per = found.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("a"), F.max("offset").alias("b"), F.countDistinct("offset").alias("d"))
    assert all((r.a, r.b, r.d) == (0, r.n - 1, r.n) for r in per.collect())
    decoded = found.select(F.from_json("value", PRICE_ROW).alias("j")).select("j.*")
    assert rows(decoded) == rows(spark.createDataFrame(sum(given, []), PRICE_ROW))
    assert progress(found).count() == per.count()


@pytest.mark.parametrize("lost", ["write_once", "move_path"])
def test_a_publisher_that_is_lost_repeats_nothing(spark, folder, monkeypatch, lost):
    log, out = f"{folder}/log", f"{folder}/out"
    outbox.publish(spark.createDataFrame(sent(0), PRICE_ROW), "prices", log, 0, BY, ORDER)

    def consume():
        sink = lambda batch, n: batch.write.mode("append").parquet(out)  # noqa: E731 - would show any repetition
        return run_available(outbox.log_stream(spark, log), sink, f"{folder}/checkpoint")

    assert consume() == 1
    real, calls = getattr(outbox, lost), []

    def broken(*args):
        calls.append(args)
        if lost == "move_path" or len(calls) == 3:  # counts and ends are written, the messages aren't
            raise RuntimeError("lost")
        return real(*args)

    again = spark.createDataFrame(sent(1), PRICE_ROW)
    with monkeypatch.context() as m:
        m.setattr(outbox, lost, broken)
        with pytest.raises(RuntimeError, match="lost"):
            outbox.publish(again, "prices", log, 1, BY, ORDER)
    assert consume() == 0
    outbox.publish(again, "prices", log, 1, BY, ORDER)
    outbox.publish(again, "prices", log, 1, BY, ORDER)
    assert consume() == 1
    assert rows(spark.read.parquet(out), "offset") == [(n,) for n in range(6)]


def test_a_run_lost_between_landing_and_publishing_is_made_up_for(spark, folder, monkeypatch):
    places = places_of(folder)
    put(places.price_inbox, *price_document(0, "5"))
    with monkeypatch.context() as m:
        m.setattr(outbox, "publish", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            daily.run_day(spark, places, chains_of(spark), dt.date.today(), keep_days=36500)
    put(places.price_inbox, *price_document(1, "6"))
    got = daily.run_day(spark, places, chains_of(spark), dt.date.today(), keep_days=36500)
    assert (got.landed, got.published, got.enriched) == (1, 2, 2)
    assert rows(spark.read.parquet(places.at("log")), "offset") == [(n,) for n in range(4)]


# ---- contract -----------------------------------------------------------------------------------


def test_measures_come_from_the_job_that_writes(spark, folder):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(seen, "id long")
    measured = Measured(df, {"n_odd": F.col("id") % 2 == 1, "n_none": F.col("id") > 100}, {"id": F.col("id")})
    measured.rows.write.parquet(folder)
    assert measured.metrics() == {"n_rows": 100, "n_odd": 50, "n_none": 0, "first_id": 0, "last_id": 99}
    assert runs.value == 100


def test_limits():
    met = {"n_rows": 10, "n_bad": 5}
    Limits({"n_bad": 0.5}, least_rows=10).check("x", met)
    Limits({"n_bad": 0.1}).check("x", {"n_rows": 0, "n_bad": 0})
    for limits in (Limits({"n_bad": 0.4}), Limits(least_rows=11)):
        with pytest.raises(BrokenContract):
            limits.check("x", met)
    with pytest.raises(ValueError, match="not measured"):
        Limits({"n_other": 1.0}).check("x", met)


def test_broken_limits_stop_the_run_and_leave_nothing(spark, folder):
    places = places_of(folder)
    put(places.price_inbox, *price_document(0, "5"))
    put(places.price_inbox, *price_document(1, "n/a"))
    strict = daily.Contract(prices=Limits({"n_unreadable_price": 0.2}))
    for _ in range(2):
        with pytest.raises(Exception, match="n_unreadable_price counts 1 of 4 rows"):
            daily.run_day(spark, places, chains_of(spark), dt.date.today(), keep_days=36500, contract=strict)
    assert not tables.matching_paths(spark, f"{landing.landed_path(places.at('prices'))}/file_day=*/batch=*")
    for never in ("log", "fact", "history/manifest", "prices_finished"):
        assert not os.path.exists(places.at(never))
    unknown = daily.Contract(fact=Limits({"n_unknown_store": 0.5}))
    with pytest.raises(Exception, match="n_unknown_store counts 4 of 4 rows"):
        daily.run_day(spark, places, chains_of(spark), dt.date.today(), keep_days=36500, contract=unknown)
    assert not tables.matching_paths(spark, places.at("fact/snapshot=*/batch=*"))
    put(places.store_inbox, *store_document(0, [("1", "a")]))
    got = daily.run_day(spark, places, chains_of(spark), dt.date.today(), keep_days=36500, contract=unknown)
    assert (got.landed, got.published, got.enriched, got.observed) == (0, 0, 1, 1)
    met = outbox.batch_metrics(spark, places.at("fact")).collect()
    assert [(r.n_rows, r.n_unknown_chain, r.n_unknown_store, r.batch) for r in met] == [(4, 0, 0, 0)]
    assert (met[0].first_file_date.date(), met[0].last_file_date.date()) == (day(0), day(1))


# ---- stores -------------------------------------------------------------------------------------


def test_stores_are_folded_delivery_by_delivery(spark, folder):
    places = places_of(folder)
    dimension, landed = places.at("store_dimension"), places.at("stores")

    def deliver():
        sink = landing.store_document_sink(landed, dimension)
        return run_available(landing_files(), sink, f"{folder}/checkpoint")

    def landing_files():
        from shelfwatch.sources.files import stream_files

        return stream_files(spark, places.store_inbox)

    def addresses():
        return rows(landing.pinned_stores(spark, dimension), "num_reshet", "storeid", "address")

    assert landing.pinned_stores(spark, dimension).count() == 0
    put(places.store_inbox, *store_document(0, [("1", "old"), ("2", "same")]))
    put(places.store_inbox, *store_document(0, [("1", "other")], "8"))
    assert deliver() == 1 and deliver() == 0
    pinned = landing.pinned_stores(spark, dimension)
    before = rows(pinned)
    put(places.store_inbox, *store_document(2, [("1", "new"), ("3", "third")]))
    deliver()
    put(places.store_inbox, *store_document(1, [("1", "late, so not the latest"), ("4", "fourth")]))
    deliver()
    assert addresses() == [("7290", "1", "new"), ("7290", "2", "same"), ("7290", "3", "third"), ("7290", "4", "fourth"), ("8", "1", "other")]
    assert rows(pinned) == before  # a run that began before reads what it began with
    assert tables.prune_versions(spark, dimension) == [1]
    assert addresses()[0] == ("7290", "1", "new")
    assert spark.read.parquet(f"{landed}/quarantined=false").count() == 7


def test_no_store_document_is_parsed_twice(spark, folder):
    places = places_of(folder)
    put(places.store_inbox, *store_document(0, [("1", "old"), (None, "no id")]))
    put(places.price_inbox, *price_document(0, "5"))
    daily.run_day(spark, places, chains_of(spark), dt.date.today(), keep_days=36500)
    shutil.rmtree(places.store_inbox)
    put(places.store_inbox, *store_document(1, [("2", "new")]))
    put(places.price_inbox, *price_document(1, "5"))
    daily.run_day(spark, places, chains_of(spark), dt.date.today(), keep_days=36500)
    assert rows(spark.read.parquet(places.at("fact")), "address") == [("old",)] * 4
    assert rows(landing.pinned_stores(spark, places.at("store_dimension")), "storeid") == [("1",), ("2",)]


def test_a_repeated_store_batch_changes_nothing(spark, folder):
    inbox = f"{folder}/in"
    put(inbox, *store_document(0, [("1", "old")]))
    sink = landing.store_document_sink(f"{folder}/stores", f"{folder}/dimension")
    names = spark.createDataFrame([(f"{inbox}/{store_document(0, [])[0]}",)], "path string")
    sink(names, 0)
    once = rows(landing.pinned_stores(spark, f"{folder}/dimension").drop("run_time"))
    sink(names, 0)
    assert rows(landing.pinned_stores(spark, f"{folder}/dimension").drop("run_time")) == once
    sink(names.limit(0), 1)
    assert tables.finished_versions(spark, f"{folder}/dimension") == [1]
    assert landing.pinned_stores(spark, f"{folder}/dimension").columns == RAW_STORE.names


def test_documents_are_gzip(folder):
    assert gzip.decompress(price_document(0, "5")[1]).startswith(b"<Root>")


# ---- tags nobody declared -----------------------------------------------------------------------


def test_no_tag_is_lost_and_declared_ones_stay(spark, folder):
    plain = price_document(0, "05.50")
    odd = price_document(1, "7")
    more = gzip.decompress(odd[1]).replace(b"</Item>", b"<New>x</New><new>y</new><Deep k='1'><a>1</a></Deep></Item>", 1)
    put(f"{folder}/in", *plain)
    put(f"{folder}/in", odd[0], gzip.compress(more))
    paths = spark.createDataFrame([(f"{folder}/in/{n}",) for n in (plain[0], odd[0])], "path string")
    landing.document_sink(f"{folder}/out")(paths, 0)
    assert rows(landing.tag_drift(spark, f"{folder}/out")) == [(odd[0], "deep", 1), (odd[0], "new", 1)]
    kept = spark.read.parquet(landing.variants_path(f"{folder}/out"))
    assert kept.count() == 2  # of the one file, its items whole
    news = kept.select(F.variant_get("item", "$.New", "array<string>").alias("n"), F.variant_get("item", "$.Deep.a", "int").alias("a"))
    assert sorted((r.n or [], r.a or 0) for r in news.collect()) == [([], 0), (["x", "y"], 1)]
    landed = spark.read.parquet(landing.landed_path(f"{folder}/out"))
    assert rows(landed, "itemcode", "itemprice", "n_other_tags")[0] == ("1", "05.50", 0) and landed.count() == 4
    [met] = outbox.batch_metrics(spark, f"{folder}/out").collect()
    assert (met.n_rows, met.n_with_other_tags) == (4, 1)


def test_without_other_tags_nothing_is_parsed_again(spark, folder):
    put(f"{folder}/in", *price_document(0, "5"))
    paths = spark.createDataFrame([(f"{folder}/in/{price_document(0, '')[0]}",)], "path string")
    landing.document_sink(f"{folder}/out")(paths, 0)
    assert not os.path.exists(landing.variants_path(f"{folder}/out"))
    assert landing.tag_drift(spark, f"{folder}/out").count() == 0


# ---- chains and routes --------------------------------------------------------------------------


def test_one_inbox_is_routed_and_the_chain_table_is_replaced(spark, folder):
    inbox = f"{folder}/in"
    places = daily.Places(inbox, inbox, f"{folder}/tables", f"{folder}/chains.csv")
    with pytest.raises(ValueError, match="no chain file"):
        daily.run_day(spark, places, None, dt.date.today())

    def run(name, n):
        with open(places.chain_file, "w") as f:
            f.write(f"reshet_name,reshet_num,vendor_website,user_name,password\n{name},7290,x,,\n")
        put(inbox, *price_document(n, "5"))
        return daily.run_day(spark, places, None, dt.date.today(), keep_days=36500)

    put(inbox, *store_document(0, [("1", "old")]))
    assert run("First", 0).landed == 1
    assert run("Second", 1).landed == 1
    os.remove(places.chain_file)
    put(inbox, *price_document(2, "5"))
    daily.run_day(spark, places, None, dt.date.today(), keep_days=36500)
    fact = spark.read.parquet(places.at("fact"))
    assert rows(fact.filter("itemcode = 1"), "file_date", "reshet_name", "address") == [
        (dt.datetime.combine(day(n), dt.time(3)), name, "old") for n, name in enumerate(["First", "Second", "Second"])
    ]
    assert tables.finished_versions(spark, places.at("chains")) == [1, 2]


def test_no_task_of_a_publication_holds_more_than_its_parts(spark, folder, monkeypatch):
    """Messages were dealt by the session's number of partitions, however many parts there were."""
    monkeypatch.setattr(outbox, "ROWS_PER_PART", 10)
    rows_ = [r for s in range(30) for r in sent(0, str(s), 20)]
    outbox.publish(spark.createDataFrame(rows_, PRICE_ROW), "prices", f"{folder}/log", 0, BY, ORDER)
    found = spark.read.parquet(f"{folder}/log").withColumn("file", F.col("_metadata.file_name"))
    assert found.count() == 600
    # As many rows as a few parts have, in files of which each is a task's.
    assert found.groupBy("file").count().agg(F.max("count")).first()[0] <= 60


def test_messages_are_read_back_by_many_tasks(spark, monkeypatch):
    """They were shuffled by log partition, four in all."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        found = catalog.QUERIES["publish_outbox"](spark, "/root/testdata/sf0.001")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "rightHint=(strategy=broadcast)" in plan
        assert found.count() == 6000
    finally:
        spark.conf.set(limit, before)
