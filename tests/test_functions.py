import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwatch.functions import casts, dates, defaults, filenames
from shelfwatch.operators.quality import cast_failures
from shelfwatch.sources.links import page_links
from tests.conftest import rows


def values(spark, column, given):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_unreadable_numbers_become_null(spark):
    given = ["12", " 7 ", "-3", "12.5", "12.", "abc", "", None, "12-3", "07x", "1e3", "99999999999999999999"]
    assert values(spark, lambda v: casts.convert(v, "bigint"), given) == [
        12, 7, -3, 12, 12, None, None, None, None, None, None, None
    ]


def test_prices_are_exact(spark):
    given = ["5.9", "5.90", "0.1234", "abc", "", None, "1e2", ".5", "99999999999999999"]
    assert values(spark, lambda v: casts.convert(v, "price"), given) == [
        Decimal("5.9000"), Decimal("5.9000"), Decimal("0.1234"), None, None, None, Decimal("100.0000"), Decimal("0.5000"), None
    ]


def test_booleans(spark):
    given = ["1", "0", "true", " No ", "2", "", None]
    assert values(spark, lambda v: casts.convert(v, "boolean"), given) == [True, False, True, False, None, None, None]


def test_cast_failures_count_only_present_values(spark):
    df = spark.createDataFrame([("abc", "1"), ("", "2"), (None, "x"), ("5", None)], "itemprice string, itemcode string")
    got = rows(cast_failures(df, {"itemprice": "price", "itemcode": "bigint"}))
    assert got == [("itemcode", 4, 1), ("itemprice", 4, 2)]


def test_calendar(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 12, 6, 1), dt.datetime(2024, 12, 9, 20)), (None, dt.datetime(2024, 1, 1)), (dt.datetime(2024, 12, 8), None)],
        "file_date timestamp, run_time timestamp",
    )
    got = [tuple(r)[2:] for r in dates.with_calendar(df).collect()]
    assert got[0] == (dt.date(2024, 12, 9), "December", "2024 - 4", True)
    assert got[1] == (dt.date(2024, 1, 1), "January", "2024 - 1", False)
    assert got[2] == (None, None, "", False)


def test_staleness_limit_is_exclusive(spark):
    file_date = dt.datetime(2024, 3, 1, 3)
    texts = ["2024-01-01", "2023-12-31", "2024-01-01 10:30", "2024/01/01", None]
    df = spark.createDataFrame([(file_date, t) for t in texts], "file_date timestamp, priceupdatedate string")
    got = [(r[2], r[3]) for r in dates.with_staleness(df).collect()]
    assert got == [(60, 0), (61, 1), (60, 0), (None, 0), (None, 0)]


def test_zip_codes(spark):
    assert values(spark, lambda z: casts.convert(defaults.zip_text(z), "int"), ["unknown", None, "12345", "12-3"]) == [
        -999, None, 12345, None
    ]


def test_file_names(spark):
    names = [
        "PriceFull7290-012-202412010300.gz",
        "Price7290-012-202412010300.gz",
        "Stores7290-202412010600.xml",
        "StoresFull7290-202412010600.xml",
        "PriceFull7290",
        "Price7290-012-xx.gz",
        "Price7290-012-209913410300.gz",
    ]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = {r.file_name: r for r in filenames.with_provenance(df).collect()}
    full = got[names[0]]
    assert (full.num_reshet, full.num_snif, full.file_date) == ("7290", "012", dt.datetime(2024, 12, 1, 3))
    assert got[names[1]].num_reshet == "7290"
    store = got[names[2]]
    assert (store.num_reshet, store.num_snif, store.file_date) == ("7290", None, dt.datetime(2024, 12, 1, 6))
    assert got[names[3]].num_reshet == "Full7290"
    assert got[names[4]].num_snif is None and got[names[4]].file_date is None
    assert got[names[5]].file_date is None and got[names[6]].file_date is None
    assert values(spark, filenames.landed_name, names[:3]) == [
        "PriceFull7290-012-202412010300.parquet",
        "Price7290-012-202412010300.parquet",
        "Stores7290-202412010600.parquet",
    ]
    assert values(spark, filenames.target_of, names[1:3]) == ["prices", "snifim"]


def test_page_links(spark):
    html = (
        '<a class="f" title="PriceFull1-2-202401010300.gz" href="x">a</a>'
        "<A href='y' title='Stores1-202401010300.xml' class='big f'>b</A>"
        '<a class="g" title="Price9-9-202401010300.gz">c</a>'
        '<a class="f" title="Promo1.gz">d</a><a class="f">e</a>'
        '<a class="f"\n title="Price&amp;3">f</a><abbr class="f" title="Price0">'
    )
    df = spark.createDataFrame([(1, html), (2, None), (3, "no links")], "page_id int, html string")
    assert [r.link for r in page_links(df).orderBy("position").collect()] == [
        "PriceFull1-2-202401010300.gz",
        "Stores1-202401010300.xml",
        "Price&3",
    ]


@pytest.mark.parametrize("city", [None, "Haifa"])
def test_defaults_fill_only_nulls(spark, city):
    df = spark.createDataFrame([(city, None, "s", "a", None)], "city string, reshet_name string, storename string, address string, zipcode string")
    got = defaults.fill_unknown(df).first()
    assert tuple(got) == (city or "Unknown", "Unknown", "s", "a", None)
