"""One day's run over delivered documents."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions.filenames import target_of
from shelfwatch.operators import lifecycle, manifest
from shelfwatch.operators.contract import Limits
from shelfwatch.sinks.tables import empty_files, path_exists, prune_versions, publish_version, read_current, write_once
from shelfwatch.sources.files import read_chains
from shelfwatch.streaming import history, intake, landing, outbox
from shelfwatch.streaming.consume import Sink, run_available


@dataclass(frozen=True)
class Places:
    """Where a run reads and writes; ``root`` holds all tables and checkpoints."""

    price_inbox: str
    store_inbox: str  # may be the same: files are routed by their names
    root: str
    chain_file: str | None = None

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass(frozen=True)
class Contract:
    """What each step's batches must keep to; a broken limit stops the run before the batch counts as finished."""

    prices: Limits = Limits({"n_unreadable_price": 0.5})
    stores: Limits = Limits({"n_quarantined": 0.9})
    fact: Limits = Limits({"n_unknown_chain": 0.9})


@dataclass(frozen=True)
class DayResult:
    landed: int  # batches of new documents, and how many of them each consumer took
    enriched: int
    observed: int
    published: int
    expired_days: list[str]
    archived_days: list[str]


TOPIC = "prices"


def replace_chains(spark: SparkSession, places: Places) -> DataFrame:
    """Replace the chain table by the delivered file, if there is one, and read what the table holds now."""
    root = places.at("chains")
    if places.chain_file and path_exists(spark, places.chain_file):
        publish_version(spark, read_chains(spark, places.chain_file), root)
        prune_versions(spark, root)
    found = read_current(spark, root)
    if found is None:
        raise ValueError("no chain file has been delivered yet")
    return found


def run_day(
    spark: SparkSession,
    places: Places,
    chains: DataFrame | None,
    today: dt.date,
    chain: str | None = None,
    keep_days: int = lifecycle.KEEP_DAYS,
    contract: Contract = Contract(),
) -> DayResult:
    """Land new documents, publish and enrich them, continue the history, then expire and archive old days.

    Damaged files are set aside by name and reason and stop nothing; bad store rows are kept as well.
    A batch beyond the limits is taken back and stops the run. Every step picks up where it stopped,
    so a run that failed anywhere is simply run again. Publication, fact and history follow the
    finished batches, each on its own checkpoint. The fact of a whole run is enriched with one
    version of the stores and, unless they are given, of the chains, which the delivered chain file replaces.
    """
    chains = replace_chains(spark, places) if chains is None else chains
    prices, stores, dimension, fact = (places.at(n) for n in ("prices", "stores", "store_dimension", "fact"))
    def take(name: str, inbox: str, target: str, sink: Sink) -> int:
        """Plan what is new in bounded batches, and do all that are planned and not finished."""
        if not path_exists(spark, inbox):
            return 0
        root = places.at(f"intake/{name}")
        listing = manifest.object_listing(spark, inbox).filter("length > 0")
        if places.price_inbox == places.store_inbox:
            listing = listing.filter(target_of(F.element_at(F.split("path", "/"), -1)) == target)
        intake.plan(listing, root)
        todo = intake.pending(spark, root, outbox.finished(spark, places.at(name)))
        for batch in todo:
            sink(intake.names(spark, root, [batch]).select("path"), batch)
        return len(todo)

    landed = take("prices", places.price_inbox, "prices", landing.document_sink(prices, contract.prices))
    empty = [(path, "empty") for path in empty_files(spark, places.price_inbox)]
    write_once(spark.createDataFrame(empty, "path string, reason string"), places.at("prices_empty_files"))
    take("stores", places.store_inbox, "snifim", landing.store_document_sink(stores, dimension, contract.stores))
    prune_versions(spark, dimension)
    pinned = landing.pinned_stores(spark, dimension)

    def follow(name: str, sink: Sink) -> int:
        if not path_exists(spark, outbox.markers_path(prices)):
            return 0
        sink = outbox.following(landing.read_landed(prices), sink)
        return run_available(outbox.finished_batches(spark, prices), sink, places.at(f"checkpoints/{name}"))

    order = ["file_name", "itemcode"]
    published = follow("publication", outbox.publish_sink(TOPIC, places.at("log"), ["num_reshet", "num_snif"], order))
    enriched = follow("fact", landing.fact_sink(None, chains, pinned, fact, contract.fact))
    observed = follow("history", history.history_sink(None, places.at("history"), chain))
    history.prune_active(spark, places.at("history"))
    expired = lifecycle.drop_expired(spark, fact, today, keep_days)
    archived = lifecycle.archive(
        spark, landing.landed_path(prices), places.at("archive"), today, keep_days, "file_day", F.col("batch")
    )
    return DayResult(landed, enriched, observed, published, expired, archived)
