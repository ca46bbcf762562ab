import gzip
import io
import os

import pytest
from pyspark.sql import functions as F

from shelfwatch.functions.filenames import with_provenance
from shelfwatch.sources import files, plain
from shelfwatch.sources.schemas import PRICE_TAGS
from shelfwatch.streaming import landing
from tests.conftest import rows

PLAIN = [
    "<Items><Item><itemcode>1</itemcode><ItemName> a &amp; b\r\nc </ItemName><New>05.50</New></Item><Item></Item></Items>",
    '<?xml version="1.0" encoding="utf-8"?>\n<Root><ChainId>7</ChainId><Items Count="2">\n <Item>\n  <ITEMCODE>007</ITEMCODE>\n  <itemname/>\n'
    "  <n>x\"\\</n><n>-5</n><n/><Truth>TRUE</Truth><day>2024-01-01</day><sum>1,5x</sum></Item>\n</Items></Root>\n",
    "\ufeff<Items><Item><itemcode>&#1488;&#x42;&quot;</itemcode><itemname>  </itemname><u>a>b</u><z>00</z><w> </w></Item></Items>",
    "<Items></Items>",
]
ODD = [
    "<Items><Item><itemcode>1</itemcode><itemcode>2</itemcode></Item></Items>",
    "<Items><Item><itemcode a='1'>1</itemcode></Item></Items>",
    "<Items><Item><a><b>1</b></a></Item></Items>",
    "<Items><Item>text<a>1</a></Item></Items>",
    "<Items><!-- c --><Item><a>1</a></Item></Items>",
    "<Items><Item><a><![CDATA[x]]></a></Item></Items>",
    "<Items><Item><a>1</a><b>2</b><a>3</a></Item></Items>",
    "<Items><Item><a>1e5</a></Item></Items>",
    "<Items><Item><a>1,234</a></Item></Items>",
    "<Items><Item><a>1</b></Item></Items>",
    "<Items><Item><a>1</a></Item>",
    "<Items><Item><a>&x;</a></Item></Items>",
    "<Items><Item><x:a>1</x:a></Item></Items>",
    "<Items><Item><a>1</a></Item></Items><Items></Items>",
    "<Items><item><a>1</a></item></Items>",
    "<Item><a>1</a></Item>",
    "<Items><Item><a>\x01</a></Item></Items>",
    "",
]


def put(folder, documents):
    os.makedirs(folder, exist_ok=True)
    for i, text in enumerate(documents):
        with open(f"{folder}/Price7290-{i:03d}-202401010300.gz", "wb") as f:
            f.write(gzip.compress(text.encode()))
    return [f"{folder}/{n}" for n in sorted(os.listdir(folder))]


def inspect(data: bytes):
    return plain.inspect(io.BytesIO(data), "Item", PRICE_TAGS)


def test_what_is_plain():
    assert [inspect(gzip.compress(t.encode())) for t in PLAIN] == [(None, True)] * len(PLAIN)
    assert [inspect(gzip.compress(t.encode())) for t in ODD] == [(None, False)] * len(ODD)
    whole = gzip.compress(PLAIN[0].encode())
    half = len(PLAIN[0]) // 2
    assert inspect(gzip.compress(PLAIN[0][:half].encode()) + gzip.compress(PLAIN[0][half:].encode())) == (None, True)
    assert [inspect(d)[0] for d in (whole[:-1], b"abc", b"")] == ["truncated", "not_gzip", "empty"]


def test_both_readers_give_the_same_rows_and_variants(spark, folder):
    paths = put(folder, PLAIN)
    by_reader = with_provenance(files.read_price_items(spark, paths, watch=True), name="source_file")
    by_columns = files.read_plain_items(spark, paths)
    columns = [c for c in by_columns.columns if c != "run_time"]
    assert rows(by_columns, *columns) == rows(by_reader, *columns) and by_columns.count() == 4
    shown = ["file_name", F.to_json("item"), F.schema_of_variant("item")]
    kept = files.read_plain_variants(spark, paths)
    reread = files.with_tags(files.read_variants(spark, paths))
    assert rows(kept, *shown) == rows(reread, *shown)
    drift = files.other_tags(kept, PRICE_TAGS)
    assert rows(drift) == rows(files.other_tags(reread, PRICE_TAGS)) and drift.count() == 8


@pytest.mark.parametrize("size", [60, 200])
def test_documents_in_pieces_are_the_same(monkeypatch, size):
    many = "<R><Items>" + "".join(f"<Item><itemcode>{i}</itemcode><New>{i}.50</New></Item>\n" for i in range(50)) + "</Items></R>"

    def read():
        found = []
        for piece, of in plain.items(iter([io.BytesIO(gzip.compress(t.encode())) for t in (many, PLAIN[0], many)]), "Item"):
            found += zip(of.tolist(), piece.columns(PRICE_TAGS)[0][1].to_pylist(), piece.variants()[0].to_pylist())
        return found

    whole = read()
    monkeypatch.setattr(plain, "PIECE", size)
    assert inspect(gzip.compress(many.encode())) == (None, True)
    assert sorted(read(), key=repr) == sorted(whole, key=repr) and len(whole) == 102


def test_plain_documents_need_no_reader_and_others_lose_nothing(spark, folder, monkeypatch):
    """Spark's reader took most of the time, above all for variants."""
    read = []
    for name in ("read_price_items", "read_variants"):
        real = getattr(landing, name)
        monkeypatch.setattr(landing, name, lambda spark, paths, real=real, **k: read.append(len(paths)) or real(spark, paths, **k))
    paths = put(f"{folder}/in", PLAIN[:2])
    landing.document_sink(f"{folder}/out")(spark.createDataFrame([(p,) for p in paths], "path string"), 0)
    assert not read
    drift = [(0, "new", 1), (1, "day", 1), (1, "n", 1), (1, "sum", 1), (1, "truth", 1)]
    drift = [(f"Price7290-{i:03d}-202401010300.gz", tag, n) for i, tag, n in drift]
    assert rows(landing.tag_drift(spark, f"{folder}/out")) == drift
    assert spark.read.parquet(landing.variants_path(f"{folder}/out")).count() == 3
    both = put(f"{folder}/more", [*PLAIN[:2], ODD[2]])
    landing.document_sink(f"{folder}/both")(spark.createDataFrame([(p,) for p in both], "path string"), 0)
    assert read == [1, 1]
    assert rows(landing.tag_drift(spark, f"{folder}/both")) == sorted([*drift, ("Price7290-002-202401010300.gz", "a", 1)])
    assert spark.read.parquet(f"{folder}/both").count() == 4
