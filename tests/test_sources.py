import datetime as dt
import gzip
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.operators import messages
from shelfwatch.plans import ingest
from shelfwatch.sources import files
from shelfwatch.sources.schemas import RAW_PRICE, RAW_STORE
from tests.conftest import rows

ITEMS = """<?xml version="1.0" encoding="utf-8"?>
<Root><ChainId>7290</ChainId><Items Count="3">
<Item><PriceUpdateDate>2024-11-30 10:00</PriceUpdateDate><ItemCode>11</ItemCode><ItemName>חלב &amp; דבש</ItemName><ItemPrice>5.90</ItemPrice><Extra>1</Extra></Item>
<Item><ITEMCODE>12</ITEMCODE><itemname> two words </itemname><ItemPrice/></Item>
<Item><ItemName>no code</ItemName></Item>
</Items></Root>"""
BROKEN = "<Root><Items><Item><ItemCode>13</ItemCode></Item><Item><ItemCode>14<ItemName>x</Item></Items></Root>"
STORES = """<?xml version="1.0" encoding="utf-16"?>
<Root><Stores><Store><StoreID>1</StoreID><StoreName>חיפה</StoreName><ZipCode>unknown</ZipCode></Store>
<Store><StoreID>2</StoreID><Address></Address></Store></Stores></Root>"""


def put(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def test_price_documents(spark, folder):
    put(folder, "PriceFull7290-012-202412010300.gz", gzip.compress(ITEMS.encode()))
    got = files.read_price_items(spark, folder)
    assert rows(got, "itemcode", "itemname", "itemprice", "source_file") == sorted(
        [
            ("11", "חלב & דבש", "5.90", "PriceFull7290-012-202412010300.gz"),
            ("12", " two words ", None, "PriceFull7290-012-202412010300.gz"),
            (None, "no code", None, "PriceFull7290-012-202412010300.gz"),
        ],
        key=repr,
    )


def test_bad_documents_go_to_quarantine_with_a_reason(spark, folder):
    put(folder, "PriceFull7290-012-202412010300.gz", gzip.compress(ITEMS.encode()))
    put(folder, "Price7290-013-202412010900.gz", gzip.compress(BROKEN.encode()))
    put(folder, "Price7290.gz", gzip.compress(ITEMS.replace("11", "15").encode()))
    labelled = ingest.price_items(files.read_price_items(spark, folder), F.lit(dt.datetime(2024, 12, 1, 20)))
    landed = ingest.good(labelled)
    assert rows(landed, "itemcode", "num_reshet", "num_snif", "file_date") == [
        ("11", "7290", "012", dt.datetime(2024, 12, 1, 3)),
        ("12", "7290", "012", dt.datetime(2024, 12, 1, 3)),
        ("13", "7290", "013", dt.datetime(2024, 12, 1, 9)),
    ]
    assert set(landed.columns) == set(RAW_PRICE.fieldNames())
    reasons = [r[0] for r in rows(ingest.quarantined(labelled), "reason")]
    assert reasons == ["bad_file_name"] * 3 + ["no_key", "unreadable"]


def test_utf16_stores(spark, folder):
    put(folder, "Stores7290-202412010600.xml", STORES.encode("utf-16"))
    got = files.read_stores(spark, folder)
    assert rows(got, "storeid", "storename", "zipcode", "address") == [
        ("1", "חיפה", "unknown", None),
        ("2", None, None, None),
    ]


def test_unknown_tags_are_found_and_lower_cased(spark, folder):
    put(folder, "a.xml", ITEMS.encode())
    got = files.read_unknown_items(spark, folder, "Item")
    assert {"itemcode", "extra"} <= set(got.columns) or "extra" in got.columns
    assert got.columns == [c.lower() for c in got.columns]


def test_imposed_schema_and_any_format(spark, folder):
    spark.createDataFrame([("1", "x")], "itemcode string, other string").write.parquet(folder)
    got = files.read_with_schema(spark, folder, RAW_STORE)
    assert got.columns == RAW_STORE.fieldNames() and got.first().storeid is None
    assert files.read_any(spark, folder).columns == ["itemcode", "other"]
    spark.createDataFrame([("1",)], "a string").write.orc(folder + "-orc")
    assert rows(files.read_any(spark, folder + "-orc", "orc")) == [("1",)]


def test_chains(spark, folder):
    put(folder, "chains.csv", b"reshet_name,reshet_num,vendor_website,user_name,password\nA,7290,w,u, pw \nB,x,w,u,\n")
    loaded = dt.datetime(2024, 12, 1)
    got = files.read_chains(spark, folder, F.lit(loaded))
    assert rows(got, "reshet_name", "reshet_num", "password", "run_time") == [
        ("A", 7290, "pw", loaded),
        ("B", None, None, loaded),
    ]


def test_messages_that_do_not_parse(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    values = ['{"a":"x","n":1}', '{"a":"x","n":1', '{"n":"z","a":"y"}', '{"q":1}', "junk", None]
    log = spark.createDataFrame([(v, "t", 0, i) for i, v in enumerate(values)], "value string, topic string, partition int, offset long")
    got = messages.decode(log, schema).orderBy("offset").collect()
    assert (got[0].a, got[0].n) == ("x", 1)
    assert [(r.a, r.n) for r in got[1:2] + got[3:]] == [(None, None)] * 4
    assert (got[2].a, got[2].n) == ("y", None)
    assert rows(messages.progress(log)) == [("t", 0, 5)]


def test_encode_leaves_out_nulls_and_round_trips(spark):
    df = spark.createDataFrame([("1", None, dt.datetime(2024, 12, 1, 3))], "itemcode string, itemname string, file_date timestamp")
    encoded = messages.encode(df)
    assert encoded.first().value == '{"itemcode":"1","file_date":"2024-12-01T03:00:00.000000Z"}'
    assert rows(messages.decode(encoded, df.schema, keep=[])) == rows(df)
