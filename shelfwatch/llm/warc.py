"""WARC archives of pages: written as transactions, read back, and assembled by concurrent-to identifiers.

Every page becomes a request, a response and a metadata record; the first and the last name the second in
WARC-Concurrent-To. Of responses with equal payloads only the one of the largest page id holds the payload, the others
are revisit records that refer to it. A record ends with a fixed separator, so Spark's text writer makes the archives;
they are read as files and cut by Content-Length, so payloads may hold anything. Assembly joins the three record types
on identifiers, of which each is rare, and gives one nested row per capture.

Defined results: a null html is an empty payload; a null url stays null; rows that repeat a page id and html are one
capture; a page id with several texts has a capture for each; a null page id comes before all others; columns other
than these three are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved
from shelfwatch.session import fresh_dir

END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
# The digits of base 32, and the profile of a revisit with the same payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    digest = F.sha1(payload)
    # Five hexadecimal digits are four of base 32.
    quads = [F.lpad(F.conv(F.substring(digest, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


# ---- writing ------------------------------------------------------------------------------------------------------


def classified(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with payload, digest, record type, and for revisits the page id of the response they refer to."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    pages = pages.withColumn("digest", sha1_base32(F.col("payload")))
    owners = pages.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("owner"))
    # Written, so that both sides of the join are plain shuffles and AQE can split a payload that many pages have.
    found = pages.join(saved(owners, "owners"), "digest", "left")
    revisit = F.col("page_id").isNull() & F.col("owner").isNotNull() | (F.col("page_id") < F.col("owner"))
    revisit = F.coalesce(revisit, F.lit(False))
    return found.select(
        "page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("owner")).alias("refers_to"),
    )


def _identifier(kind: str, page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), F.col("digest"), F.lit(f":{kind}>"))


def _record(kind: Column, identifier: Column, content_type: str, block: Column, *more: tuple[str, Column]) -> Column:
    """The text of a record up to its separator; header lines with a null value are left out."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", identifier), ("WARC-Date", F.lit(DATE)), *more]
    lines += [("Content-Type", F.lit(content_type)), ("Content-Length", F.octet_length(block).cast("string"))]
    written = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in lines]
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("", *written), F.lit("\r\n"), block)


def records(found: DataFrame) -> DataFrame:
    """The three records of each classified page."""
    response = _identifier("response", F.col("page_id"))
    url = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit(END), F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""),
    )
    revisit = F.col("record_type") == "revisit"
    get = F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(" HTTP/1.1" + END))
    about = F.to_json(F.struct("page_id", "url"))
    together = ("WARC-Concurrent-To", response)
    parts = [
        _record(F.lit("request"), _identifier("request", F.col("page_id")), "application/http; msgtype=request", get, ("WARC-Target-URI", url), together),
        _record(
            F.col("record_type"), response, "application/http; msgtype=response", http, ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Refers-To", F.when(revisit, _identifier("response", F.col("refers_to")))),
            ("WARC-Profile", F.when(revisit, F.lit(SAME_PAYLOAD))),
        ),
        _record(F.lit("metadata"), _identifier("metadata", F.col("page_id")), "application/json", about, together),
    ]
    return found.select(F.explode(F.array(*parts)).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Writes gzip-compressed archives, each file a sequence of whole records."""
    records(classified(pages, least)).write.option("lineSep", END).option("compression", "gzip").text(path)


# ---- reading ------------------------------------------------------------------------------------------------------


def parse(data: bytes):
    """(headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        begin = end + 4
        at = begin + int(headers["Content-Length"])
        yield headers, data[begin:at]
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record that begins at byte {begin} doesn't end where it says")
        at += 4


_FIELDS = [
    ("kind", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
    ("uri", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.string()), ("about", pa.string()),
]
RECORDS = "kind string, record_id string, concurrent_to string, refers_to string, uri string, digest string, payload_bytes long, payload string, about string"


def _row(headers: dict, block: bytes, with_payload: bool) -> dict:
    kind = headers["WARC-Type"]
    row = {
        "kind": kind, "record_id": headers["WARC-Record-ID"], "concurrent_to": headers.get("WARC-Concurrent-To"),
        "refers_to": headers.get("WARC-Refers-To"), "uri": headers.get("WARC-Target-URI"),
    }
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        row["digest"] = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        row["payload_bytes"] = int(re.search(rb"Content-Length: (\d+)", http)[1])
        if kind == "response":
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != row["digest"] or len(payload) != row["payload_bytes"]:
                raise ValueError(f"the payload of {row['record_id']} isn't what was written")
            row["payload"] = payload.decode() if with_payload else None
    elif kind == "metadata":
        row["about"] = json.dumps(json.loads(block))
    return row


def _read(with_payload: bool):
    schema = pa.schema(_FIELDS)

    def rows(batches):
        for batch in batches:
            for content in batch.column("content"):
                data = zlib.decompressobj(31)
                found, size = [], 0
                for headers, block in parse(data.decompress(content.as_py()) + data.flush()):
                    found.append(_row(headers, block, with_payload))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema)

    return rows


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record. Responses are checked against their digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read(with_payload), RECORDS)


def captures(found: DataFrame) -> DataFrame:
    """One row per capture: page_id and the nested response, request and metadata records."""
    answers = found.filter("kind IN ('response', 'revisit')").dropDuplicates(["record_id"])
    asked = found.filter("kind = 'request'").dropDuplicates(["concurrent_to"])
    told = found.filter("kind = 'metadata'").dropDuplicates(["concurrent_to"])
    about = F.from_json("about", "page_id long, url string")
    answers = answers.select("record_id", F.struct("kind", "record_id", "refers_to", "uri", "digest", "payload_bytes", "payload").alias("response"))
    asked = asked.select(F.col("concurrent_to").alias("record_id"), F.struct("record_id", "uri").alias("request"))
    told = told.select(F.col("concurrent_to").alias("record_id"), about.alias("metadata"))
    return answers.join(asked, "record_id", "left").join(told, "record_id", "left").select(
        F.col("metadata.page_id").alias("page_id"), "response", "request", "metadata"
    )


def capture_digests(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the pages as archives, reads them back, and gives each capture's page, payload and type."""
    spark = pages.sparkSession
    path = fresh_dir(spark, "llm-warc")
    write_archives(pages, path, least)
    found = captures(read_archives(spark, path, with_payload=False))
    referred = F.regexp_extract("response.refers_to", "^<urn:x-page:(-?[0-9]+):", 1)
    return found.select(
        "page_id", F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"), F.when(F.length(referred) > 0, referred).cast("long").alias("refers_to"),
    )


ORACLE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda k:
    substr('{BASE32}', ((('0x' || substr(hex, 5 * k + 1, 5))::INT >> 15) & 31) + 1, 1)
    || substr('{BASE32}', ((('0x' || substr(hex, 5 * k + 1, 5))::INT >> 10) & 31) + 1, 1)
    || substr('{BASE32}', ((('0x' || substr(hex, 5 * k + 1, 5))::INT >> 5) & 31) + 1, 1)
    || substr('{BASE32}', (('0x' || substr(hex, 5 * k + 1, 5))::INT & 31) + 1, 1)), '') AS payload_digest
  FROM p
), o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS owner FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < owner THEN owner END AS refers_to
FROM o
"""
