"""Every operator as a query over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions import dates, defaults, filenames
from shelfwatch.functions.casts import convert_columns, to_whole
from shelfwatch.operators import asof, coverage, dedup, lifecycle, manifest, messages, quality, scd2
from shelfwatch.plans import enrich, fixtures, history, ingest
from shelfwatch.session import fresh_dir, tune
from shelfwatch.sinks import compaction, tables
from shelfwatch.sinks.documents import write_xml_documents
from shelfwatch.sinks.messages import publish_files
from shelfwatch.sources import files, links
from shelfwatch.sources.messages import file_stream
from shelfwatch.sources.schemas import (
    ENTITY,
    MESSAGE,
    PRICE_TAGS,
    RAW_PRICE,
    RAW_STORE,
    STORE_TAGS,
    TYPED_FACT,
    TYPED_PRICE,
    TYPED_STORE,
)
from shelfwatch.streaming import history as stream_history
from shelfwatch.streaming import intake, landing, outbox
from shelfwatch.streaming.consume import run_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIDDLE_DAY = "2024-01-16"
LANDED_BEFORE = "2000-01-01"
LATE_ABOVE = 60


def _plain_stamps(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the type of the given tables."""
    stamps = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(stamps) if stamps else df


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_stamps(fn(tune(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


def _latest(df: DataFrame, day: Column) -> Column:
    """The newest day of a table, as a scalar subquery."""
    return df.agg(F.max(day)).scalar()


# ---- enrichment ---------------------------------------------------------------------------------


def _some_dimensions(spark, sf):
    """Chains and stores that some prices find no match in."""
    return fixtures.chains(spark, sf, some=True), fixtures.stores(spark, sf, some=True)


@query
def price_fact(spark, sf):
    return enrich.price_fact(fixtures.prices(spark, sf), *_some_dimensions(spark, sf))


@query
def calendar_attrs(spark, sf):
    return dates.with_calendar(fixtures.prices(spark, sf, ["itemcode", "file_name", "file_date", "run_time"]))


@query
def join_chain(spark, sf):
    prices = fixtures.prices(spark, sf, ["itemcode", "file_name", "num_reshet"])
    return enrich.join_chain(prices, fixtures.chains(spark, sf, some=True))


@query
def join_store(spark, sf):
    prices = fixtures.prices(spark, sf, ["itemcode", "file_name", "num_reshet", "num_snif"])
    return enrich.join_store(prices, fixtures.stores(spark, sf, some=True))


@query
def staleness(spark, sf):
    return dates.with_staleness(fixtures.prices(spark, sf, ["itemcode", "priceupdatedate", "file_date"]))


@query
def default_fill(spark, sf):
    prices = fixtures.prices(spark, sf, ["itemcode", "file_name", "num_reshet", "num_snif"])
    joined = enrich.with_dimensions(prices, *_some_dimensions(spark, sf))
    return defaults.fill_unknown(joined).drop("zipcode")


@query
def zip_sentinel(spark, sf):
    text = defaults.zip_text(F.col("zipcode"))
    return fixtures.stores(spark, sf).select(
        "storeid", "file_name", "zipcode", to_whole(text, "int").alias("zip_number")
    )


# ---- typed raw layer ----------------------------------------------------------------------------


@query
def typed_projection(spark, sf):
    return convert_columns(fixtures.prices(spark, sf), TYPED_PRICE)


@query
def typed_stores(spark, sf):
    return convert_columns(fixtures.stores(spark, sf), TYPED_STORE)


@query
def json_encode(spark, sf):
    return messages.encode(fixtures.prices(spark, sf))


@query
def backfill_messages(spark, sf):
    """Landed store files published again, under the stores' own schema."""
    path = fresh_dir(spark, "landed")
    tables.write_partitioned(fixtures.stores(spark, sf), path, ["num_reshet"])
    return ingest.republish(spark, path, RAW_STORE)


@query
def json_decode(spark, sf):
    return messages.decode(fixtures.log_messages(spark, sf), T.StructType([T.StructField("k", T.LongType())]))


@query
def filename_attrs(spark, sf):
    names = (
        fixtures.prices(spark, sf, ["file_name"])
        .union(fixtures.stores(spark, sf).select("file_name"))
        .distinct()
    )
    named = filenames.with_provenance(names).drop("run_time")
    return named.withColumns(
        {
            "landed_name": filenames.landed_name(F.col("file_name")),
            "target": filenames.target_of(F.col("file_name")),
        }
    )


@query
def scan_parquet_schema(spark, sf):
    wanted = T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
            T.StructField("l_comment", T.StringType()),
        ]
    )
    return files.read_with_schema(spark, f"{sf}/lineitem.parquet", wanted)


@query
def filter_full_files(spark, sf):
    columns = ["itemcode", "itemprice", "file_name", "num_reshet", "num_snif", "file_date"]
    return scd2.full_files(fixtures.prices(spark, sf, columns), chain="15")


# ---- one record per key -------------------------------------------------------------------------


@query
def latest_per_day(spark, sf):
    return dedup.latest_per_day(fixtures.prices(spark, sf))


@query
def store_dedup(spark, sf):
    return dedup.latest_stores(fixtures.stores(spark, sf))


@query
def store_dedup_rows(spark, sf):
    columns = ["num_reshet", "storeid", "storename", "address", "city", "zipcode"]
    return dedup.distinct_rows(fixtures.stores(spark, sf).select(*columns))


@query
def dup_audit(spark, sf):
    return manifest.duplicate_names(fixtures.prices(spark, sf, ["file_name"]))


# ---- price history ------------------------------------------------------------------------------


def _daily(spark, sf):
    return scd2.daily_observations(fixtures.observations(spark, sf))


def _before_and_batch(spark, sf):
    """History up to the day before the newest, and the newest day as the batch."""
    daily = _daily(spark, sf)
    newest = _latest(fixtures.observations(spark, sf), F.to_date("file_date"))
    before = daily.filter(F.col("file_date") < newest)
    return scd2.build_versions(before), daily.filter(F.col("file_date") == newest)


@query
def scd2_build(spark, sf):
    return scd2.build_versions(_daily(spark, sf))


@query
def scd2_full_files(spark, sf):
    columns = ["itemcode", "itemname", "itemprice", "file_name", "num_reshet", "num_snif", "file_date"]
    return history.history_from_files(fixtures.prices(spark, sf, columns))


@query
def scd2_classify(spark, sf):
    matched = scd2.classify(*_before_and_batch(spark, sf))
    return matched.select(
        *ENTITY, F.col("o.itemprice").alias("old_price"), F.col("n.itemprice").alias("new_price"), "Action"
    )


@query
def scd2_apply(spark, sf):
    return scd2.apply_batch(*_before_and_batch(spark, sf))


@query
def scd2_merge(spark, sf):
    daily, middle = _daily(spark, sf), F.lit(MIDDLE_DAY).cast("date")
    before = scd2.build_versions(daily.filter(F.col("file_date") < middle))
    return scd2.merge_batch(before, daily.filter(F.col("file_date") >= middle))


@query
def scd2_late(spark, sf):
    """Expensive observations arrive after all others."""
    obs = fixtures.observations(spark, sf)
    log = scd2.daily_observations(obs.filter(F.col("value") <= LATE_ABOVE))
    late = scd2.daily_observations(obs.filter(F.col("value") > LATE_ABOVE))
    return scd2.rebuild_entities(scd2.build_versions(log), log, late)


@query
def scd2_current(spark, sf):
    return scd2.current(scd2.build_versions(_daily(spark, sf)))


@query
def scd2_closed(spark, sf):
    return scd2.closed(scd2.build_versions(_daily(spark, sf)))


@query
def scd2_as_of(spark, sf):
    """The day's final price next to each observation."""
    probes = fixtures.observations(spark, sf).select(
        "event_id", *ENTITY, F.to_date("file_date").alias("as_of")
    )
    return asof.as_of(probes, scd2.build_versions(_daily(spark, sf)))


@query
def scd2_valid_on(spark, sf):
    return asof.valid_on(scd2.build_versions(_daily(spark, sf)), F.lit(MIDDLE_DAY).cast("date"))


# ---- retention, archive, sinks ------------------------------------------------------------------


def _snapshots(spark, sf):
    prices = fixtures.prices(spark, sf, ["itemcode", "file_name", "itemprice", "run_time"])
    return prices.withColumn("snapshot", F.to_date("run_time"))


def _today(spark, sf):
    return _latest(fixtures.prices(spark, sf, ["run_time"]), F.to_date("run_time"))


@query
def retention_keep(spark, sf):
    return lifecycle.keep(_snapshots(spark, sf), _today(spark, sf))


@query
def retention_expired(spark, sf):
    return lifecycle.expired(_snapshots(spark, sf), _today(spark, sf))


@query
def retention_metrics(spark, sf):
    return lifecycle.retention_metrics(_snapshots(spark, sf), _today(spark, sf))


@query
def archive_partitions(spark, sf):
    live, stored = fresh_dir(spark, "live"), fresh_dir(spark, "archive")
    obs = fixtures.observations(spark, sf).drop("value").withColumn("snapshot", F.to_date("file_date"))
    tables.write_partitioned(obs, live, ["snapshot"])
    today = obs.agg(F.max("snapshot")).first()[0]
    lifecycle.archive(spark, live, stored, today)
    columns = ["event_id", "itemcode", "itemprice", "snapshot"]
    return (
        spark.read.parquet(live)
        .select(*columns, F.lit("live").alias("place"))
        .unionByName(spark.read.parquet(stored).select(*columns, F.lit("archive").alias("place")))
    )


@query
def compact_files(spark, sf):
    """Observations in many small files per day, packed, and read by the newest snapshot."""
    path = fresh_dir(spark, "small")
    obs = fixtures.observations(spark, sf).drop("value").withColumn("snapshot", F.to_date("file_date"))
    obs.repartition("num_reshet").write.partitionBy("snapshot", "num_reshet").parquet(path)
    obs.repartition("itemcode").write.mode("append").partitionBy("snapshot", "num_reshet").parquet(path)
    compaction.take_snapshot(spark, path)
    compaction.compact(spark, path, obs.schema, ["snapshot", "num_reshet"])
    compaction.expire(spark, path)
    return compaction.read_snapshot(spark, path, obs.schema).groupBy(*obs.columns).agg(F.count("*").alias("n"))


@query
def sink_partitioned_fact(spark, sf):
    """Written twice: the second run replaces its own partitions."""
    path = fresh_dir(spark, "fact")
    fact = enrich.price_fact(
        fixtures.observation_records(spark, sf).drop("value"), *fixtures.observed_dimensions(spark, sf)
    )
    for _ in range(2):
        tables.write_partitioned(fact, path, ["snapshot"])
    return spark.read.parquet(path).select(*enrich.FACT)


@query
def versioned_replace(spark, sf):
    """A second version of the history computed from the first one it replaces."""
    root = fresh_dir(spark, "scd")
    records = fixtures.observation_records(spark, sf).drop("value")
    middle = F.lit(MIDDLE_DAY).cast("timestamp")
    history.refresh_history(spark, records.filter(F.col("file_date") < middle), root)
    history.refresh_history(spark, records.filter(F.col("file_date") >= middle), root)
    return tables.read_current(spark, root)


@query
def external_table_sql(spark, sf):
    path = fresh_dir(spark, "prices")
    tables.write_once(fixtures.prices(spark, sf), path)
    tables.expose_external(spark, "prices_external", path, RAW_PRICE)
    return spark.sql(
        """SELECT num_reshet, count(*) AS n_prices, count(DISTINCT itemcode) AS n_items,
                  CAST(sum(CAST(itemprice AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS total_price
           FROM prices_external GROUP BY num_reshet"""
    )


# ---- ingest -------------------------------------------------------------------------------------


@query
def xml_items(spark, sf):
    """Price items written as gzipped documents of stores, one folder per chain, and parsed back.

    An item is one line: blanks between its tags are about a fifth of the characters to write, pack and parse. The level of
    gzip is the fastest, which makes a file a third larger and takes a quarter of the time to pack.
    """
    path = fresh_dir(spark, "items")
    tags = PRICE_TAGS
    prices = fixtures.prices(spark, sf, [*tags, "num_reshet", "num_snif"])
    (
        prices.repartition("num_reshet", "num_snif").drop("num_snif").write.format("xml")
        .option("rootTag", "Items")
        .option("rowTag", "Item")
        .option("indent", "")
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .partitionBy("num_reshet")
        .save(path)
    )
    return files.read_price_items(spark, path).select(*tags, F.col("num_reshet").cast("string"))


@query
def xml_stores_utf16(spark, sf):
    path = fresh_dir(spark, "stores")
    tags = STORE_TAGS
    (
        fixtures.stores(spark, sf)
        .select(*tags)
        .write.format("xml")
        .option("rootTag", "Stores")
        .option("rowTag", "Store")
        .option("encoding", "UTF-16")
        .option("declaration", 'version="1.0" encoding="UTF-16"')
        .save(path)
    )
    return files.read_stores(spark, path).select(*tags)


@query
def stream_stores(spark, sf):
    """Store documents in two waves, each folded into the dimension when it comes."""
    inbox, landed, dimension, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "stores", "dimension", "checkpoint"))
    stores = fixtures.stores(spark, sf)
    first = F.col("file_date") < F.lit(LANDED_BEFORE).cast("timestamp")
    for wave in (stores.filter(first), stores.filter(~first)):
        write_xml_documents(wave.select(*STORE_TAGS, "file_name"), inbox, "Stores", "Store", encoding="UTF-16")
        for _ in range(2):  # the second time nothing is new
            run_available(files.stream_files(spark, inbox), landing.store_document_sink(landed, dimension), checkpoint)
    return landing.pinned_stores(spark, dimension).drop("run_time")


@query
def ingest_bad_files(spark, sf):
    """Price documents, one per store and kind, of which some are not gzip: what was landed of each, or why not."""
    inbox, landed, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "prices", "checkpoint"))
    tags = PRICE_TAGS
    for bad in (False, True):
        prices = fixtures.documents(spark, sf, bad)
        write_xml_documents(prices.select(*tags, "file_name"), inbox, "Items", "Item", compression=None if bad else "gzip")
        run_available(files.stream_files(spark, inbox), landing.document_sink(landed), checkpoint)
    status = spark.read.parquet(landing.files_path(landed)).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "reason")
    rows = spark.read.parquet(landing.landed_path(landed)).groupBy("file_name").agg(F.count("*").alias("n_rows"))
    return status.join(rows, "file_name", "left")


@query
def unknown_tags(spark, sf):
    """Price documents with two tags that nobody declared, on some of their items."""
    inbox, landed, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "prices", "checkpoint"))
    prices = fixtures.documents(spark, sf, bad=False)
    more = [
        F.when(F.col("allowdiscount") == "1", F.col("itemprice")).alias("PriceBefore"),
        F.when(F.col("itemstatus") == "R", F.array(F.lit("a"), F.lit("b"))).alias("ReturnReason"),
    ]
    write_xml_documents(prices.select(*PRICE_TAGS, *more, "file_name"), inbox, "Items", "Item", compression="gzip")
    run_available(files.stream_files(spark, inbox), landing.document_sink(landed), checkpoint)
    return landing.tag_drift(spark, landed)


@query
def page_links(spark, sf):
    return links.page_links(
        fixtures.table(spark, sf, "pages"), attr="href", prefixes=("/",), css_class=None
    )


@query
def file_manifest(spark, sf):
    return manifest.file_manifest(fixtures.prices(spark, sf, ["file_name", "file_date"]))


@query
def new_files_anti(spark, sf):
    """Files listed but not planned yet, when everything before a date was taken in two batches."""
    root, listed = fresh_dir(spark, "intake"), fresh_dir(spark, "listed")
    seen = manifest.file_manifest(fixtures.prices(spark, sf, ["file_name", "file_date"]))
    tables.write_once(seen.select(F.col("file_name").alias("path"), F.col("n_rows").alias("length"), "last_date"), listed)
    listing = spark.read.parquet(listed)
    full = F.col("path").startswith(filenames.FULL_PREFIX)
    taken = listing.filter(F.col("last_date") < F.lit(LANDED_BEFORE).cast("timestamp"))
    for batch in (taken.filter(full), taken):
        intake.plan(batch, root)
    return manifest.named(intake.unseen(listing, root).select(F.col("path").alias("file_name")))


@query
def ingest_quarantine(spark, sf):
    schema = T.StructType([T.StructField("itemcode", T.StringType()), T.StructField("itemprice", T.StringType())])
    checked = ingest.price_messages(fixtures.damaged_messages(spark, sf), schema)
    return ingest.quarantined(checked).select("offset", "reason", "value")


@query
def ingest_good(spark, sf):
    schema = T.StructType([T.StructField("itemcode", T.StringType()), T.StructField("itemprice", T.StringType())])
    checked = ingest.price_messages(fixtures.damaged_messages(spark, sf), schema)
    return ingest.good(checked).select("offset", "itemcode", "itemprice")


@query
def dim_chain_load(spark, sf):
    path = fresh_dir(spark, "chains")
    padded = fixtures.chains(spark, sf).select(
        F.concat(F.lit("  "), "reshet_name", F.lit(" ")).alias("reshet_name"),
        "reshet_num",
        "vendor_website",
        F.lit(None).cast("string").alias("user_name"),
        F.lit(None).cast("string").alias("password"),
    )
    keep_blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    padded.write.option("header", "true").options(**keep_blanks).csv(path)
    loaded_at = F.lit("2024-12-01 20:00:00").cast("timestamp")
    return files.read_chains(spark, path, loaded_at, trimmed=["reshet_name", "password"]).select(
        "reshet_name", "reshet_num", "vendor_website", "run_time"
    )


# ---- contracts and quality ----------------------------------------------------------------------


def _coverage(spark, sf):
    """Known stores, the days they delivered files on, and the first and last day of all files."""
    expected = enrich.store_dimension(fixtures.stores(spark, sf))
    delivered = fixtures.prices(spark, sf, ["num_reshet", "num_snif", "file_date"]).select(
        "num_reshet", to_whole(F.col("num_snif"), "int").alias("num_snif"), F.to_date("file_date").alias("day")
    )
    days = fixtures.prices(spark, sf, ["file_date"]).select(F.to_date("file_date").alias("day"))
    first, last = (days.agg(f("day")).scalar() for f in (F.min, F.max))
    return expected, delivered, ["num_reshet", "num_snif"], "day", first, last


@query
def coverage_missing(spark, sf):
    """Days without any file, per known store, over the span of all files."""
    return coverage.missing_days(*_coverage(spark, sf))


@query
def coverage_gaps(spark, sf):
    """The same as stretches of days."""
    return coverage.gaps(*_coverage(spark, sf))


@query
def dq_cast_failures(spark, sf):
    return quality.cast_failures(fixtures.prices(spark, sf), {**TYPED_PRICE, **TYPED_FACT})


@query
def dq_unmatched_dims(spark, sf):
    prices = fixtures.prices(spark, sf, ["itemcode", "file_name", "num_reshet", "num_snif"])
    joined = enrich.with_dimensions(prices, *_some_dimensions(spark, sf))
    return quality.unmatched_dimensions(
        joined, {"chain": F.col("reshet_name").isNull(), "store": F.col("storename").isNull()}
    )


@query
def dq_varchar_overflow(spark, sf):
    """Checked against the declared widths and, for the names, against narrower ones."""
    fact = price_fact(spark, sf)
    return quality.too_long(fact, {**quality.FACT_WIDTHS, "file_name": 30, "itemname": 10})


@query
def dq_scd2_invariants(spark, sf):
    return quality.history_violations(scd2.build_versions(_daily(spark, sf)))


@query
def batch_metrics(spark, sf):
    return quality.batch_metrics(fixtures.prices(spark, sf, ["file_name", "file_date"]))


@query
def offset_progress(spark, sf):
    return messages.progress(fixtures.log_messages(spark, sf))


@query
def offset_audit(spark, sf):
    """Lost and repeated stretches of a log in which no product events and the signups twice have come."""
    log = fixtures.log_messages(spark, sf, kinds=True).withColumn("offset", F.expr("offset div 4"))
    kept = log.filter(F.col("kind") != "purchase")
    return messages.audit(kept.union(log.filter(F.col("kind") == "signup")))


@query
def publish_outbox(spark, sf):
    """Whole price records published in two batches, each tried twice, and read back from the log."""
    log = fresh_dir(spark, "log")
    prices = fixtures.prices(spark, sf)
    full = F.col("file_name").startswith(filenames.FULL_PREFIX)
    for publication, batch in enumerate([prices.filter(full), prices.filter(~full)]):
        for _ in range(2):
            outbox.publish(batch, "prices", log, publication, ["num_reshet", "num_snif"], ["file_name", "itemcode"])
    found = spark.read.schema(MESSAGE).parquet(log)
    ends = found.groupBy("partition").agg(F.max("offset").alias("last"), F.count("*").alias("n"))
    # One row per partition; a join that shuffles the messages would leave a task per partition.
    gapless = found.join(F.broadcast(ends.filter(F.col("last") == F.col("n") - 1)), "partition")
    return messages.decode(gapless, RAW_PRICE, keep=["topic"])


# ---- streams ------------------------------------------------------------------------------------


def _price_log(records: DataFrame) -> DataFrame:
    """Price records as messages of a four-partition log."""
    return records.select(
        F.to_json(F.struct(*RAW_PRICE.fieldNames()), messages.EXACT_TIME).alias("value"),
        F.lit("prices").alias("topic"),
        F.pmod(F.xxhash64("file_name"), F.lit(4)).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
    )


def _run_waves(spark, waves: list[DataFrame], sinks: dict) -> None:
    """Append each wave to a log, then let every consumer catch up from its own checkpoint."""
    log = fresh_dir(spark, "log")
    checkpoints = {name: fresh_dir(spark, f"checkpoint-{name}") for name in sinks}
    for wave in waves:
        publish_files(wave, log)
        for name, sink in sinks.items():
            run_available(file_stream(spark, log), sink, checkpoints[name])


def _halves(records: DataFrame) -> list[DataFrame]:
    middle = F.lit(MIDDLE_DAY).cast("timestamp")
    return [records.filter(F.col("file_date") < middle), records.filter(F.col("file_date") >= middle)]


@query
def stream_incremental(spark, sf):
    """The log grows twice and is then read a third time without news."""
    out = fresh_dir(spark, "parsed")
    log = fixtures.log_messages(spark, sf)
    half = log.agg(F.expr("max(offset) div 2")).first()[0]
    waves = [log.filter(F.col("offset") <= half), log.filter(F.col("offset") > half)]
    schema = T.StructType([T.StructField("k", T.LongType())])
    _run_waves(spark, waves, {"parsed": landing.parsed_sink(schema, out)})
    return spark.read.parquet(out).drop("batch")


@query
def stream_two_sinks(spark, sf):
    """Two consumers of one log, the fact and the parsed rows, each with all it has taken."""
    fact, parsed = fresh_dir(spark, "fact"), fresh_dir(spark, "parsed")
    sinks = {
        "fact": landing.fact_sink(RAW_PRICE, *fixtures.observed_dimensions(spark, sf), fact),
        "parsed": landing.parsed_sink(RAW_PRICE, parsed),
    }
    waves = [_price_log(h) for h in _halves(fixtures.observation_records(spark, sf))]
    _run_waves(spark, waves, sinks)

    def taken(path: str, name: str, *more: Column) -> DataFrame:
        columns = ["file_name", F.col("itemcode").cast("string"), F.col("itemprice").cast("string"), "file_date"]
        return spark.read.parquet(path).select(F.lit(name).alias("consumer"), *columns, *more)

    none = F.lit(None).cast("string")
    return taken(fact, "fact", F.col("reshet_name"), F.col("storename")).unionByName(
        taken(parsed, "parsed", none.alias("reshet_name"), none.alias("storename"))
    )


@query
def stream_dedup(spark, sf):
    """The first half is sent twice, then the second half together with the first half again."""
    out = fresh_dir(spark, "unique")
    first, second = _halves(fixtures.observation_records(spark, sf))
    waves = [_price_log(first.union(first)), _price_log(second.union(first))]
    sink = landing.unique_sink(RAW_PRICE, ["file_name", "itemcode"], out, fresh_dir(spark, "rejected"))
    _run_waves(spark, waves, {"unique": sink})
    return spark.read.parquet(out).select("file_name", "itemcode", "itemprice", "num_reshet", "file_date")


@query
def stream_scd2(spark, sf):
    """History kept batch by batch: two halves in order, then observations that come late."""
    root = fresh_dir(spark, "history")
    records = fixtures.observation_records(spark, sf)
    on_time = records.filter(F.col("value") <= LATE_ABOVE)
    waves = [_price_log(w) for w in [*_halves(on_time), records.filter(F.col("value") > LATE_ABOVE)]]
    _run_waves(spark, waves, {"history": stream_history.history_sink(RAW_PRICE, root)})
    return stream_history.read_history(spark, root, stream_history.latest_batch(spark, root))
