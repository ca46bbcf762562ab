"""Small inputs and plain re-computations for the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed: int, n: int, vocabulary: int = 5000) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
