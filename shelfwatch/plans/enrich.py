"""The enriched price fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.casts import convert_columns, to_whole
from shelfwatch.functions.dates import with_calendar, with_staleness
from shelfwatch.functions.defaults import fill_unknown, zip_text
from shelfwatch.operators.dedup import latest_stores
from shelfwatch.operators.lookup import attach
from shelfwatch.sources.schemas import FACT_SOURCE, TYPED_FACT

FACT = [
    *FACT_SOURCE,
    "reshet_name",
    "storename",
    "address",
    "city",
    "zipcode",
    "days_since_last_price_update",
    "is_price_update_stale",
]
_SPREAD = ["itemcode", "file_name"]


def join_chain(prices: DataFrame, chains: DataFrame) -> DataFrame:
    """Add ``reshet_name``. Both keys are numbers: a chain code that is none matches nothing."""
    dim = chains.select(F.col("reshet_num").cast("bigint").alias("_chain"), "reshet_name")
    keyed = prices.withColumn("_chain", to_whole(F.col("num_reshet"), "bigint"))
    return attach(keyed, dim, ["_chain"], _SPREAD).drop("_chain")


def store_dimension(stores: DataFrame) -> DataFrame:
    """One row per chain and numeric store id, from its latest delivery."""
    typed = stores.withColumn("storeid", to_whole(F.col("storeid"), "int")).dropna(
        subset=["num_reshet", "storeid"]
    )
    return latest_stores(typed).select(
        "num_reshet", F.col("storeid").alias("num_snif"), "storename", "address", "city", "zipcode"
    )


def join_store(prices: DataFrame, stores: DataFrame) -> DataFrame:
    """Add the store's name, address, city and zip code; ``num_snif`` becomes a number."""
    keyed = prices.withColumn("num_snif", to_whole(F.col("num_snif"), "int"))
    delivered = stores.select("num_reshet", "storeid", "storename", "address", "city", "zipcode")
    return attach(
        keyed, store_dimension(stores), ["num_reshet", "num_snif"], _SPREAD, derived_from=delivered
    )


def with_dimensions(prices: DataFrame, chains: DataFrame, stores: DataFrame) -> DataFrame:
    return prices.transform(join_chain, chains).transform(join_store, stores)


def price_fact(prices: DataFrame, chains: DataFrame, stores: DataFrame) -> DataFrame:
    """Raw prices to the 28-column fact. With broadcast dimensions the prices never shuffle."""
    return (
        with_calendar(prices)
        .select(*FACT_SOURCE)
        .transform(with_dimensions, chains, stores)
        .transform(with_staleness)
        .transform(fill_unknown)
        .withColumn("zipcode", zip_text(F.col("zipcode")))
        .transform(convert_columns, TYPED_FACT)
        .select(*FACT)
    )
