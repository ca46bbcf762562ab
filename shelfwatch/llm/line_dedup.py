"""Removal of repeated blocks of lines, cut where the content says so. Built-in functions only.

A rolling hash over the hashes of a line and the line before it decides whether a chunk ends there. The cut depends on
two lines alone, so text put in front shifts no later boundary, and a block that many documents share is cut alike in
all of them. Chunks of two lines or more are counted by digest; only the texts of those seen again are gathered, and
they are compared byte by byte as keys. The first occurrence, by document and place, stays; the others go.

Counts are added up before the shuffle, and what is looked up per chunk goes through joins that AQE can split, so a
block that a third of the documents hold never meets in one task. Texts move once, spread by document.

Defined results: a null or empty text has no lines and stays as it is; a chunk of blank lines only is never removed;
one-line chunks stay; rows that repeat an id and the text are the same occurrence, and both keep it; rows that share an
id but not the text are documents of their own, in the order of their texts' hashes; a null id comes before all others;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved

# One line in CUT_ONE_IN ends a chunk; BACK weighs the line before.
CUT_ONE_IN = 4
BACK = 31


def line_hash(line: Column) -> Column:
    """The first 32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def with_chunks(docs: DataFrame) -> DataFrame:
    """Adds `lines` and `starts`: the lines of the text, and the index from which each chunk runs."""
    empty = F.array().cast("array<string>")
    docs = docs.withColumn("lines", F.when(F.length("text") > 0, F.split("text", "\n", -1)).otherwise(empty))
    docs = docs.withColumn("hashes", F.transform("lines", line_hash))
    # An offset of one, so that the value at place i decides whether a chunk starts at line i.
    ends = F.transform(
        "hashes",
        lambda h, i: (h + BACK * F.when(i > 0, F.get("hashes", i - 1)).otherwise(0)) % CUT_ONE_IN == 0,
    )
    docs = docs.withColumn("ends", ends)
    places = F.transform("hashes", lambda _, i: i)
    starts = F.filter(places, lambda i: (i == 0) | F.get("ends", i - 1))
    return docs.withColumn("starts", starts).drop("hashes", "ends")


def chunk_lines(number: Column) -> Column:
    """The lines of the chunk of that number."""
    begin = F.get("starts", number)
    return F.slice("lines", begin + 1, F.coalesce(F.get("starts", number + 1), F.size("lines")) - begin)


def _chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk of two lines or more that holds text."""
    numbered = with_chunks(docs).select(
        "doc_id", "hash", F.posexplode(F.transform("starts", lambda _, k: chunk_lines(k))).alias("chunk", "chunk_lines")
    )
    text = F.array_join("chunk_lines", "\n")
    return numbered.filter(F.size("chunk_lines") > 1).select("doc_id", "hash", "chunk", text.alias("chunk_text")).filter(
        F.col("chunk_text").rlike(r"[^ \t\n\x0B\f\r]")
    )


def _same(one: str, two: str) -> Column:
    """Whether rows of two tables are of one document."""
    return F.col(f"{one}.doc_id").eqNullSafe(F.col(f"{two}.doc_id")) & (F.col(f"{one}.hash") == F.col(f"{two}.hash"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per document: doc_id, n_lines, n_chunks, n_removed (lines), kept_text (null only for a null text).

    Columns named in `carry` come along as the struct `carried`.
    """
    carried = F.struct(*(carry or [])).alias("carried")
    # Beside the texts, so that these are shuffled in one form only; a row is known by its id and its text's hash.
    beside = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("hash"), carried).dropDuplicates(["doc_id", "hash"])
    # A document is known by its id and its text's hash; the place in the table is these and the chunk's number.
    docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    digests = saved(_chunks(docs).select("doc_id", "hash", "chunk", F.unhex(F.md5("chunk_text")).alias("digest")), "chunks")
    # What is looked up is written first, so that both sides of the joins are plain shuffles and AQE can split them.
    seen_again = digests.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    repeated = digests.join(saved(seen_again, "repeated"), "digest", "left_semi")
    candidates = repeated.groupBy("doc_id", "hash").agg(F.collect_set("chunk").alias("candidates"))

    found = docs.alias("t").join(candidates.alias("c"), _same("t", "c")).select("t.doc_id", "t.hash", "t.text", "c.candidates")
    texts = with_chunks(found).select(
        "doc_id",
        "hash",
        F.explode(
            F.transform("candidates", lambda k: F.struct(k.alias("chunk"), F.array_join(chunk_lines(k), "\n").alias("chunk_text")))
        ).alias("c"),
    )
    texts = texts.select(
        "doc_id", "hash", "c.chunk", "c.chunk_text", F.unhex(F.md5("c.chunk_text")).alias("digest"), F.struct("doc_id", "hash", "c.chunk").alias("place")
    )
    owners = saved(texts.groupBy("digest", "chunk_text").agg(F.min("place").alias("owner")), "owners")
    removed = (
        texts.join(owners, ["digest", "chunk_text"]).filter(F.col("place") != F.col("owner"))
        .groupBy("doc_id", "hash").agg(F.collect_set("chunk").alias("removed"))
    )

    if carry:
        known = beside.alias("b").join(removed.alias("r"), _same("b", "r"), "left")
        removed = known.select("b.doc_id", "b.hash", "carried", "removed")
    whole = docs.alias("t").join(removed.alias("r"), _same("t", "r"), "left").select("t.doc_id", "t.text", "removed", *(["carried"] if carry else []))
    none = F.array().cast("array<int>")
    whole = with_chunks(whole).withColumn("removed", F.coalesce("removed", none))
    numbers = F.transform("starts", lambda _, k: k)
    kept = F.flatten(F.transform(F.array_except(numbers, "removed"), chunk_lines))
    return whole.withColumn("kept", kept).select(
        "doc_id",
        F.size("lines").alias("n_lines"),
        F.size("starts").alias("n_chunks"),
        (F.size("lines") - F.size("kept")).alias("n_removed"),
        F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join("kept", "\n")).alias("kept_text"),
        *(["carried"] if carry else []),
    )


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, i, ls[i] AS line, ('0x' || substr(md5(ls[i]), 1, 8))::BIGINT AS h
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE length(text) > 0) d,
       LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i) r
), cuts AS (
  SELECT *, (h + {BACK} * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {CUT_ONE_IN} = 0 AS ends
  FROM lines
), placed AS (
  SELECT doc_id, i, line,
    coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM cuts
), chunks AS (
  SELECT doc_id, chunk, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk_text
  FROM placed GROUP BY doc_id, chunk
), judged AS (
  SELECT doc_id, chunk, n, chunk_text,
    n > 1 AND regexp_matches(chunk_text, '[^ \\t\\n\\x0B\\f\\r]')
      AND row_number() OVER (PARTITION BY chunk_text ORDER BY doc_id, chunk) > 1 AS gone
  FROM chunks
), kept AS (
  SELECT doc_id, sum(n)::INT AS n_lines, count(*)::INT AS n_chunks, coalesce(sum(n) FILTER (gone), 0)::INT AS n_removed,
    coalesce(string_agg(chunk_text, chr(10) ORDER BY chunk) FILTER (NOT gone), '') AS kept_text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept_text, d.text)) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
