import collections
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwatch.llm import sharding
from shelfwatch.llm.queries import QUERIES
from shelfwatch.llm.sharding import granted, quotas, shard_documents
from tests.conftest import SMALL
from tests.llm.helpers import docs_of


def check(rows, docs, shards):
    """The contract, and how many groups are cut."""
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = collections.defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    text, where = dict(docs), collections.defaultdict(collections.Counter)
    for r in rows:
        if text.get(r.doc_id) is not None:
            where[text[r.doc_id]][r.shard] += 1
    return where


@pytest.mark.parametrize("bucket", [50_000, 9])
def test_groups_stay_together(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", bucket)
    texts = [None] * 5 + [""] * 4 + ["hot"] * 200 + [f"g{k}" for k in range(40) for _ in range(1 + k % 6)] + [f"one {k}" for k in range(800)]
    docs = list(enumerate(texts))
    where = check(shard_documents(docs_of(spark, texts), 12).collect(), docs, 12)
    cut = [t for t, c in where.items() if len(c) > 1]
    assert len(where["hot"]) <= 3 and len(cut) <= 2
    assert sum(max(c.values()) for t, c in where.items() if t.startswith("g")) >= 0.95 * sum(1 for t in texts if (t or "").startswith("g"))


@pytest.mark.parametrize("texts", [[], ["a"], ["a"] * 7, ["a", None, "", "b"] * 3, ["x"] * 50 + ["y"] * 50])
def test_small_and_uniform_tables(spark, texts):
    check(shard_documents(docs_of(spark, texts), 5).collect(), list(enumerate(texts)), 5)


def test_repeated_null_ids_clashing_columns(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, "ü" * 50000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as slot", "3 as row_key", "4 as rank")
    check(shard_documents(docs, 3).collect(), rows, 3)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 4), st.integers(0, 4)).filter(lambda p: p[0] != p[1]), st.integers(1, 30), max_size=15),
       st.lists(st.integers(0, 60), min_size=5, max_size=5))
def test_grants_keep_quotas(requests, spare):
    load = [sum(n for (a, _), n in requests.items() if a == s) + spare[s] // 3 for s in range(5)]
    quota = [load[s] + spare[s] // 2 for s in range(5)]
    out = granted(requests, load, quota)
    for s in range(5):
        after = load[s] + sum(n for (_, b), n in out.items() if b == s) - sum(n for (a, _), n in out.items() if a == s)
        assert after <= quota[s]
    assert all(0 < n <= requests[k] for k, n in out.items())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    where = check(QUERIES["op8_sharding"](spark, SMALL).collect(), docs, 40)
    assert quotas(len(docs), 40) == [5] * 40
    assert sum(len(c) > 1 for c in where.values()) <= 1
