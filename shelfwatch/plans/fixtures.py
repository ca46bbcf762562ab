"""Raw retail records derived from the given tables, over all of their rows.

The same definitions exist as SQL in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.sources.schemas import PRICE, RAW_PRICE, RAW_STORE

# Chain codes of the observation log, one per event type (fixed values).
OBS_CHAINS = {
    "view": 7290000000001,
    "click": 7290000000002,
    "signup": 7290000000003,
    "purchase": 7290000000004,
    "error": 7290000000005,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(column: str, width: int) -> Column:
    """Zero-padded number; longer numbers are kept whole."""
    text = F.col(column).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _stamp(column: str) -> Column:
    return F.col(column).cast("timestamp")


def _price_text(column: str) -> Column:
    return F.col(column).cast(PRICE).cast("string")


def prices(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Raw price records: one per order line.

    The lookups are left joins on unique keys, so one whose columns are not asked for is left out.
    """
    wanted = columns or RAW_PRICE.fieldNames()
    rows = table(spark, sf_dir, "lineitem")
    if {"num_reshet", "file_name"} & set(wanted):
        supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        rows = rows.join(supplier, "l_suppkey", "left")
    if "priceupdatedate" in wanted:
        orders = table(spark, sf_dir, "orders")
        rows = rows.join(
            orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority"),
            "l_orderkey",
            "left",
        )
    if {"itemname", "manufacturername", "manufactureritemdescription", "qtyinpackage", "unitofmeasureprice"} & set(
        wanted
    ):
        part = table(spark, sf_dir, "part")
        rows = rows.join(part.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "left")

    full = F.col("l_linestatus") == "F"
    # Full files come at 03:00, later ones at 06:00 plus the line number.
    hours = F.when(full, F.lit(3)).otherwise(F.col("l_linenumber") + 6)
    file_date = F.timestamp_add("HOUR", hours, _stamp("l_shipdate"))
    rows = rows.withColumns(
        {
            **({"num_reshet": F.col("s_nationkey").cast("string")} if "s_nationkey" in rows.columns else {}),
            "num_snif": _padded("l_suppkey", 6),
            "file_date": file_date,
            "run_time": F.timestamp_add("HOUR", F.lit(20), _stamp("l_shipdate")),
        }
    )
    no_text = F.lit(None).cast("string")
    # Orders without a priority carry their date in a form that is no valid date text.
    updated = F.when(
        F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "dd.MM.yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    made = {
        "priceupdatedate": updated,
        "itemcode": F.col("l_partkey").cast("string"),
        "itemtype": F.lit("1"),
        "itemname": F.col("p_name"),
        "manufacturername": F.col("p_brand"),
        "manufacturecountry": no_text,
        "manufactureritemdescription": F.col("p_type"),
        "unitqty": no_text,
        "quantity": _price_text("l_quantity"),
        "unitofmeasure": no_text,
        "bisweighted": F.lit("0"),
        "qtyinpackage": F.col("p_size").cast("string"),
        "itemprice": _price_text("l_extendedprice"),
        "unitofmeasureprice": _price_text("p_retailprice"),
        "allowdiscount": F.when(F.col("l_discount") > 0, "1").otherwise("0"),
        "itemstatus": F.col("l_returnflag"),
        "itemid": no_text,
        "file_name": F.concat(
            F.when(full, "PriceFull").otherwise("Price"),
            "num_reshet",
            F.lit("-"),
            "num_snif",
            F.lit("-"),
            F.date_format("file_date", "yyyyMMddHHmm"),
            F.lit(".gz"),
        ),
        "num_reshet": F.col("num_reshet"),
        "num_snif": F.col("num_snif"),
        "file_date": F.col("file_date"),
        "run_time": F.col("run_time"),
        "kind": F.when(full & F.col("l_shipdate").isNotNull(), "PriceFull").otherwise("Price"),
    }
    return rows.select(*[made[c].alias(c) for c in wanted])


def chains(spark: SparkSession, sf_dir: str, some: bool = False) -> DataFrame:
    """Registered chains: all nations; with ``some``, those outside Europe, so that some prices have no chain."""
    listed = table(spark, sf_dir, "region")
    if some:
        listed = listed.filter(F.col("r_name") != "EUROPE")
    return (
        table(spark, sf_dir, "nation")
        .join(listed, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("reshet_name"),
            F.col("n_nationkey").cast("bigint").alias("reshet_num"),
            F.concat(F.lit("https://"), F.lower("r_name"), F.lit(".example")).alias("vendor_website"),
        )
    )


def stores(spark: SparkSession, sf_dir: str, some: bool = False) -> DataFrame:
    """Stores as delivered twice, the second time with some changed addresses; with ``some``, only those of
    suppliers below a balance, so that some prices have no store."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    listed = table(spark, sf_dir, "supplier")
    if some:
        listed = listed.filter(F.col("s_acctbal") < 8000)
    first = F.when(F.col("s_acctbal") >= 500, F.concat(F.lit("Street "), F.col("s_suppkey").cast("string")))
    later = F.when(
        F.col("s_acctbal") >= 6000, F.concat(F.lit("Avenue "), F.col("s_suppkey").cast("string"))
    ).otherwise(first)
    deliveries = F.array(
        F.struct(F.lit("1995-01-01 06:00:00").alias("stamp"), first.alias("address")),
        F.struct(F.lit("2001-01-01 06:00:00").alias("stamp"), later.alias("address")),
    )
    zipcode = F.when(F.col("s_acctbal") < 2500, "unknown").when(
        F.col("s_acctbal") >= 4000, _padded("s_suppkey", 5)
    )
    rows = listed.join(nation, "s_nationkey", "left").withColumn("d", F.explode(deliveries))
    stamp = F.col("d.stamp").cast("timestamp")
    return rows.select(
        F.col("s_suppkey").cast("string").alias("storeid"),
        F.lit(None).cast("string").alias("bikoretno"),
        F.lit("1").alias("storetype"),
        F.col("s_name").alias("storename"),
        F.col("d.address").alias("address"),
        F.col("n_name").alias("city"),
        zipcode.alias("zipcode"),
        F.concat(
            F.lit("Stores"), F.col("s_nationkey").cast("string"), F.lit("-"), F.date_format(stamp, "yyyyMMddHHmm"), F.lit(".xml")
        ).alias("file_name"),
        F.col("s_nationkey").cast("string").alias("num_reshet"),
        stamp.alias("file_date"),
        stamp.alias("run_time"),
    )


def observed_dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Chains and stores of the observations: a chain per event type but one, and the one store of each but another."""
    code = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(n)) for t, n in OBS_CHAINS.items()])
    kinds = table(spark, sf_dir, "events").select("event_type", code.alias("code")).distinct()
    chains = kinds.filter("event_type != 'error'").select(F.col("event_type").alias("reshet_name"), F.col("code").alias("reshet_num"))
    stamp = F.lit("1995-01-01 06:00:00").cast("timestamp")
    given = {
        "storeid": F.lit("001"), "storename": F.initcap("event_type"), "city": F.lit("Here"), "zipcode": F.lit("unknown"),
        "file_name": F.concat(F.lit("Stores"), F.col("code").cast("string"), F.lit("-199501010600.xml")),
        "num_reshet": F.col("code").cast("string"), "file_date": stamp, "run_time": stamp,
    }
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW_STORE}
    stores = kinds.filter("event_type != 'signup'").select(*[(given.get(c) if c in given else m).alias(c) for c, m in missing.items()])
    return chains, stores


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations: one per event, several per entity and day."""
    chain = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(n)) for t, n in OBS_CHAINS.items()])
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("itemcode"),
        F.concat(F.lit("item-"), F.col("event_id").cast("string")).alias("itemname"),
        F.floor(F.col("value") / 20).cast(PRICE).alias("itemprice"),
        _stamp("ts").alias("file_date"),
        chain.alias("num_reshet"),
        F.lit(1).alias("num_snif"),
        F.concat(F.lit("PriceFull"), chain.cast("string"), F.lit("-1-"), _padded("event_id", 12)).alias(
            "file_name"
        ),
        F.col("value"),
    )


def documents(spark: SparkSession, sf_dir: str, bad: bool) -> DataFrame:
    """Raw prices by document: one of each kind per store; bad ones are those of suppliers in debt."""
    debt = table(spark, sf_dir, "supplier").filter((F.col("s_acctbal") < 0) == F.lit(bad))
    debt = debt.select(_padded("s_suppkey", 6).alias("num_snif"))
    rows = prices(spark, sf_dir, [*RAW_PRICE.fieldNames(), "kind"]).join(debt, "num_snif", "left_semi")
    return rows.withColumn("file_name", F.concat("kind", "num_reshet", F.lit("-"), "num_snif", F.lit("-199901010300.gz"))).drop("kind")


def log_messages(spark: SparkSession, sf_dir: str, kinds: bool = False) -> DataFrame:
    """A four-partition message log with the events' own JSON as values; with ``kinds``, the events' type too."""
    return table(spark, sf_dir, "events").select(
        F.col("props").alias("value"),
        F.lit("prices").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        *([F.col("event_type").alias("kind")] if kinds else []),
    )


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price messages of which some are cut off, some lack the item and some have no price."""
    kind = F.col("event_type")
    price = F.when(kind == "signup", F.lit("n/a")).otherwise(F.col("value").cast(PRICE).cast("string"))
    item = F.when(kind != "view", F.col("user_id").cast("string"))
    value = F.to_json(F.struct(item.alias("itemcode"), price.alias("itemprice")))
    return table(spark, sf_dir, "events").select(
        F.when(kind == "error", value.substr(F.lit(1), F.length(value) - 1)).otherwise(value).alias("value"),
        F.lit("prices").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def observation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as raw price records."""
    obs = observations(spark, sf_dir)
    given = {
        "itemcode": F.col("itemcode").cast("string"),
        "itemname": F.col("itemname"),
        "itemprice": F.col("itemprice").cast("string"),
        "file_name": F.col("file_name"),
        "num_reshet": F.col("num_reshet").cast("string"),
        "num_snif": F.col("num_snif").cast("string"),
        "file_date": F.col("file_date"),
        "run_time": F.col("file_date"),
    }
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW_PRICE}
    return obs.select(*[(given.get(c) if c in given else m).alias(c) for c, m in missing.items()], "value")
