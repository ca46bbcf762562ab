"""Record layouts: raw (all text), typed, and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Prices are compared for equality in the history, so they are exact decimals. Four places hold
# unit prices (per 100 g and the like) as well as shelf prices.
PRICE = T.DecimalType(18, 4)


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


_STAMPS = [T.StructField("file_date", T.TimestampType()), T.StructField("run_time", T.TimestampType())]

# Child tags of one price item (fixed values; the reader matches them in any letter case).
PRICE_TAGS = [
    "priceupdatedate",
    "itemcode",
    "itemtype",
    "itemname",
    "manufacturername",
    "manufacturecountry",
    "manufactureritemdescription",
    "unitqty",
    "quantity",
    "unitofmeasure",
    "bisweighted",
    "qtyinpackage",
    "itemprice",
    "unitofmeasureprice",
    "allowdiscount",
    "itemstatus",
    "itemid",
]
# Child tags of one store (fixed values).
STORE_TAGS = ["storeid", "bikoretno", "storetype", "storename", "address", "city", "zipcode"]

RAW_PRICE = T.StructType(_strings([*PRICE_TAGS, "file_name", "num_reshet", "num_snif"]) + _STAMPS)
RAW_STORE = T.StructType(_strings([*STORE_TAGS, "file_name", "num_reshet"]) + _STAMPS)

CHAIN = T.StructType(
    [
        T.StructField("reshet_name", T.StringType()),
        T.StructField("reshet_num", T.LongType()),
        T.StructField("vendor_website", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("password", T.StringType()),
        T.StructField("run_time", T.TimestampType()),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# Target types of the typed raw layers; columns not listed stay text or timestamps.
TYPED_PRICE = {
    "priceupdatedate": "timestamp",
    "itemcode": "bigint",
    "itemtype": "int",
    "quantity": "price",
    "bisweighted": "int",
    "itemprice": "price",
    "unitofmeasureprice": "price",
    "allowdiscount": "int",
    "itemstatus": "int",
    "itemid": "int",
    "num_reshet": "bigint",
    "num_snif": "int",
}
TYPED_STORE = {"storeid": "int", "bikoretno": "int", "storetype": "int", "num_reshet": "bigint"}

# Target types of the enriched fact.
TYPED_FACT = {
    "allowdiscount": "boolean",
    "itemcode": "bigint",
    "itemprice": "price",
    "num_reshet": "bigint",
    "priceupdatedate": "timestamp",
    "unitofmeasureprice": "price",
    "zipcode": "int",
}

# Columns the fact takes from the raw price, after the calendar columns were added.
FACT_SOURCE = (
    "snapshot snapshot_month snapshot_quarter is_weekend itemcode itemname manufacturername "
    "manufacturecountry manufactureritemdescription unitqty unitofmeasure qtyinpackage itemprice "
    "unitofmeasureprice allowdiscount file_name num_reshet priceupdatedate file_date run_time num_snif"
).split()

# Declared text widths of the fact table (fixed values).
FACT_WIDTHS = {
    "snapshot_month": 10,
    "snapshot_quarter": 10,
    "itemname": 100,
    "manufacturername": 50,
    "manufacturecountry": 20,
    "manufactureritemdescription": 100,
    "unitqty": 30,
    "unitofmeasure": 25,
    "qtyinpackage": 7,
    "file_name": 50,
    "reshet_name": 50,
    "storename": 50,
    "address": 30,
    "city": 30,
}

ENTITY = ["itemcode", "num_reshet", "num_snif"]
SCD = [
    "itemcode",
    "itemname",
    "itemprice",
    "StartDate",
    "EndDate",
    "IsActive",
    "num_reshet",
    "num_snif",
]
