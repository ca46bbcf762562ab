"""The queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import decontaminate as op6
from shelfwatch.llm import embedding_dedup as op1
from shelfwatch.llm import hard_negatives as op13
from shelfwatch.llm import jaccard_join as op7
from shelfwatch.llm import language_id as op11
from shelfwatch.llm import line_dedup as op10
from shelfwatch.llm import packing as op5
from shelfwatch.llm import quality as op2
from shelfwatch.llm import secrets as op4
from shelfwatch.llm import sharding as op8
from shelfwatch.llm import substring_dedup as op3
from shelfwatch.llm import token_alignment as op12
from shelfwatch.llm import warc as op9
from shelfwatch.llm.workers import send_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark, sf_dir):
    return op1.embedding_links(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_quality(spark, sf_dir):
    return op2.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark, sf_dir):
    found = op3.substring_dedup(_table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_secrets(spark, sf_dir):
    return op4.digest(op4.secret_spans(_table(spark, sf_dir, "documents")))


def op5_packing(spark, sf_dir):
    return op5.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), length=2048)


def op6_decontaminate(spark, sf_dir):
    found = op6.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=13)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_jaccard_join(spark, sf_dir):
    return op7.jaccard_components(_table(spark, sf_dir, "documents"), ngram=5, percent=75)


def op8_sharding(spark, sf_dir):
    found = op8.shard_documents(_table(spark, sf_dir, "documents"), shards=40)
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_warc(spark, sf_dir):
    return op9.capture_digests(_table(spark, sf_dir, "pages"), least=0)


def op10_line_dedup(spark, sf_dir):
    found = op10.line_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_chunks", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_language_id(spark, sf_dir):
    return op11.identify(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark, sf_dir):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return op12.token_alignment(_table(spark, sf_dir, "documents"), *paths)


def op13_hard_negatives(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op13.hard_negatives(vectors.withColumn("label", label), anchor=F.col("id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_dedup,
        op2_quality,
        op3_substring_dedup,
        op4_secrets,
        op5_packing,
        op6_decontaminate,
        op7_jaccard_join,
        op8_sharding,
        op9_warc,
        op10_line_dedup,
        op11_language_id,
        op12_token_alignment,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {"op9_warc": op9.ORACLE, "op10_line_dedup": op10.ORACLE, "op13_hard_negatives": op13.ORACLE}
