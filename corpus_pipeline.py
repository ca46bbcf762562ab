"""From raw documents to packed training sequences, in five stages. Each stage is written and read again."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelfwatch.llm import decontaminate, jaccard_join, line_dedup, packing, quality  # noqa: E402
from shelfwatch.llm.tables import saved, small  # noqa: E402
from shelfwatch.llm.words import BLOCK_BYTES  # noqa: E402
from shelfwatch.llm.workers import send_package  # noqa: E402


def _ready(spark: SparkSession) -> None:
    """Python tasks get texts by the block, not 64 MB at a time, as an executor holds a batch twice for each of its tasks."""
    send_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BLOCK_BYTES))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer finds bad or toxic go. Null and empty texts stay, repeated rows are judged each."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated blocks of lines go, and with them documents of which nothing is left.

    Null and empty texts stay. Rows that repeat id and text are one occurrence, each of which gets the other columns of
    one of them; rows of one id, or none, and different texts are documents of their own.
    """
    _ready(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    # Written before it is filtered: a filter pushed into the operator would work out every line's hash again per chunk.
    found = saved(line_dedup.line_dedup(docs, carry=[*others, "n_chars"]), "lines-left")
    found = found.filter((F.col("n_removed") == 0) | (F.length("kept_text") > 0))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("carried.n_chars"))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": n_chars}
    columns |= {c: F.col("carried").getField(c) for c in others}
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def _key_of(docs: DataFrame) -> str:
    """A name that the documents have no column of. A row is known by its id, which may be null or repeated, and its text."""
    name = "_row_key"
    while name in docs.columns:
        name += "_"
    return name


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    return docs.withColumn(key, F.xxhash64("doc_id", "text"))


def _without(docs: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """The rows of `docs`, which has keys, whose key is none of those."""
    return docs.join(small(saved(keys.select(key).distinct(), name)), key, "left_anti")


def _one_of_equal(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows that repeat id and text once. Only the texts of those that do are shuffled."""
    again = saved(ids.filter("n > 1").select(key), "repeated-rows")
    if again.isEmpty():
        return docs
    again = small(again)
    return docs.join(again, key, "left_anti").unionByName(docs.join(again, key, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one of the smallest id stays, of a null id before all; of equal rows, one.

    Null and empty texts link with nothing and stay.
    """
    _ready(spark)
    key = _key_of(docs)
    keyed = _keyed(docs, key)
    ids = saved(keyed.groupBy(key).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "row-keys")
    once = _one_of_equal(keyed, ids, key)
    found = jaccard_join.jaccard_components(once.select(key, "text"), id_col=key)
    found = saved(found.select(F.col("doc_id").alias(key), "component_id").distinct().join(small(ids), key), "components")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", key)).alias("first"))
    first = saved(first.select(F.col("first").getField(key).alias(key)), "first-rows")
    return _without(once, found.join(small(first), key, "left_anti"), key, "copies").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages to the limit or beyond go. Null and empty texts hold none."""
    key = _key_of(docs)
    keyed = _keyed(docs, key)
    found = decontaminate.decontaminate(keyed.select(F.col(key).alias("doc_id"), "text"), _table(spark, sf_dir, "benchmark"))
    gone = found.filter("contaminated").select(F.col("doc_id").alias(key))
    return _without(keyed, gone, key, "contaminated").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces in training sequences; of a null or empty text, the closing id alone."""
    _ready(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048)


STAGES = [
    ("quality classifier", reject_bad),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

# Neither the scorer nor the packing can be said in SQL; the tests compare the pipeline with a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the documents table on."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
