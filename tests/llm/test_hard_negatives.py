import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwatch.llm import hard_negatives as op
from shelfwatch.llm.hard_negatives import Best, SortedLists, hard_negatives


def plain(rows, every=50):
    """The contract by scoring everything against everything, in whole numbers of any size."""
    valid = set()
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            valid.add((i, label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a in valid:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], c[2])), c) for c in valid if c != a]
        for p, c in sorted(x for x in scored if x[1][1] == a[1])[:5]:
            near = sorted(x for x in scored if x[1][1] != a[1] and 50 * -p <= 100 * -x[0] <= 95 * -p)[:3]
            out += [(a[0], c[0], k + 1, n[1][0], -p, -n[0]) for k, n in enumerate(near)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def random_rows(n, dims=6, seed=1, labels=3):
    r = np.random.default_rng(seed)
    return [(i, r.normal(0, 0.3, dims).tolist(), int(r.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block,group", [(16_384, 1_024), (37, 2)])
def test_equals_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(op, "BLOCK_ROWS", block)
    monkeypatch.setattr(op, "GROUP_ANCHORS", group)
    rows = random_rows(600)
    assert got(hard_negatives(table(spark, rows), F.col("id") % 50 == 0)) == plain(rows) != []


def test_copies_ties_and_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 50)
    rows = random_rows(120, dims=3, labels=2)
    rows += [(1000 + i, [0.5, 0.25, 0.0], 0) for i in range(200)]  # copies under ids of their own: ties
    rows += [(2000 + i, [0.375, 0.125, 0.1], 1) for i in range(30)]
    assert got(hard_negatives(table(spark, rows), F.col("id") % 50 == 0)) == plain(rows)


def test_odd_rows(spark):
    odd = [
        (0, None, 1), (50, [0.1, None], 1), (100, [float("nan")], 1), (150, [float("inf")], 0), (200, [0.5, 0.5], None), (None, [0.5, 0.5], 1),
        (250, [], 1), (300, [], 1), (350, [0.0, 0.0], 0), (400, [1e300, 0.0], 1), (450, [0.7], 1), (500, [0.7, 0.1, 0.3], 0), (-50, [0.6, -0.2], 0),
    ]
    rows = odd + random_rows(80, dims=2) + [(50, [0.3, 0.3], 1), (50, [0.3, 0.3], 1), (50, [0.2, 0.4], 0)]
    df = table(spark, rows).withColumns({"id": F.lit(7), "key": F.lit("x"), "q": F.lit(1), "block": F.lit(2), "rank": F.lit(3)})
    huge = spark.createDataFrame([([1e300, -1e300],), ([2.0],)], "v array<double>").select(op.whole_numbers(F.col("v"), 256).alias("q"))
    assert [r.q for r in huge.collect()] == [[math.isqrt(2**62), -math.isqrt(2**62)], [512]]
    assert hard_negatives(df, F.col("id") % 50 == 0).columns[0] == "anchor_id"
    small = [r for r in rows if r[0] != 400]
    assert got(hard_negatives(df.filter("vec_id IS NULL OR vec_id != 400"), F.col("id") % 50 == 0)) == plain(small)


def test_empty(spark):
    assert hard_negatives(table(spark, []), F.col("id") % 50 == 0).count() == 0
    assert hard_negatives(table(spark, [(1, [0.5], 1)]), F.col("id") % 50 == 0).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.integers(1, 8))
def test_reading_stops_without_losing_rows(seed, n, dims):
    r = np.random.default_rng(seed)
    q = r.integers(-9, 9, (n, dims)) if seed % 2 else r.integers(-(2**29), 2**29, (n, dims))
    anchor = r.integers(-9, 9, dims)
    ids, keys = r.permutation(n), np.zeros(n, np.int64)
    scores = q @ anchor
    for low, high in ((None, None), (int(np.median(scores)) // 2, int(np.quantile(scores, 0.9)))):
        best = Best(4, low, high)
        for rows, found, threshold in SortedLists(q, 9).walk(anchor):
            assert (found == scores[rows]).all()
            best.take(rows, found, ids, keys)
            if best.settled(threshold):
                break
        inside = np.flatnonzero((scores >= low) & (scores <= high)) if low is not None else np.arange(n)
        assert best.rows.tolist() == inside[np.lexsort((ids[inside], -scores[inside]))][:4].tolist()


def test_few_rows_are_read_where_lists_decide():
    q = np.zeros((10_000, 4), np.int64)
    q[:, 0] = np.arange(10_000)
    best, read = Best(5), 0
    for rows, scores, threshold in SortedLists(q, 1).walk(np.array([1, 0, 0, 0])):
        best.take(rows, scores, np.arange(10_000), np.zeros(10_000, np.int64))
        read += len(rows)
        if best.settled(threshold):
            break
    assert best.rows.tolist() == [9999, 9998, 9997, 9996, 9995] and read <= op.FIRST_DEPTH
