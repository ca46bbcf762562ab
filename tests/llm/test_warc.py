import base64
import glob
import gzip
import hashlib

import pytest

from shelfwatch.llm.warc import capture_digests, captures, parse, read_archives, write_archives

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a.example/x", "<p>same</p>"), (2, "http://b.example/ y\nz", "<p>same</p>"), (3, None, None), (4, "", ""),
    (5, "http://c.example/ü", "über\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n🎉"), (6, "u", "\r\n\r\n"), (7, "u", "x" * 300000),
    (9, "u", "<p>same</p>"), (8, "u", "x" * 300000), (-4, "neg", "only \x00 here"), (10, "q", "tail "), (11, "q", " tail"),
]


def plain(pages, least=0):
    rows, owner = {}, {}
    data = [(p, u, (h or "").encode()) for p, u, h in pages]
    for p, _, b in data:
        if len(b) >= least:
            owner[b] = max(p, owner.get(b, p))
    for p, _, b in data:
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        again = b in owner and p < owner[b]
        rows[p] = (len(b), digest, "revisit" if again else "response", owner[b] if again else None)
    return rows


@pytest.mark.parametrize("least", [0, 12])
def test_equals_brute_force(spark, least):
    got = {r.page_id: tuple(r)[1:] for r in capture_digests(spark.createDataFrame(PAGES, SCHEMA), least).collect()}
    assert got == plain(PAGES, least)


def test_round_trip_of_payloads_and_urls(spark, folder):
    write_archives(spark.createDataFrame(PAGES, SCHEMA), folder)
    rows = {r.page_id: r for r in captures(read_archives(spark, folder)).collect()}
    assert len(rows) == len(PAGES)
    payloads = {r.response.record_id: r.response.payload for r in rows.values()}
    for page_id, url, html in PAGES:
        r = rows[page_id]
        assert payloads[r.response.refers_to or r.response.record_id] == (html or "")
        assert r.metadata.url == url and r.request.record_id.endswith(":request>")
    files = glob.glob(f"{folder}/*.gz")
    kinds = [h["WARC-Type"] for f in files for h, _ in parse(gzip.open(f).read())]
    assert len(kinds) == 3 * len(PAGES) and kinds.count("metadata") == len(PAGES)


def test_damage_is_noticed():
    good = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in parse(good + good)] == [b"abc"] * 2
    for bad in (good.replace(b": 3", b": 2"), b"GET" + good):
        with pytest.raises(ValueError):
            list(parse(bad))


def test_empty_repeated_null_ids_clashing_columns(spark):
    assert capture_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "u", "a"), (1, "u", "a"), (1, "u", "b"), (None, "u", "a"), (None, "u", "c")]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as payload", "2 as digest", "3 as owner")
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to or 0) for r in capture_digests(pages).collect())
    assert got == [(0, 1, "response", 0), (0, 1, "revisit", 1), (1, 1, "response", 0), (1, 1, "response", 0)]
