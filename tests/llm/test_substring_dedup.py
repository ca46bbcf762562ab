import collections
import hashlib
import itertools

import pytest

from shelfwatch.llm.queries import QUERIES
from shelfwatch.llm.substring_dedup import COVERS, period_for, substring_dedup
from tests.conftest import SMALL
from tests.llm.helpers import by_id, docs_of, prose


def plain(texts, window):
    split = [(t or "").encode().split() for t in texts]
    count = collections.Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("period,cover", COVERS.items())
def test_covers_align_any_two_places(period, cover):
    for i, j in itertools.product(range(period), repeat=2):
        assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_period_leaves_an_anchor():
    assert period_for(35) == 21 and period_for(12) == 1 and period_for(3) == 1


@pytest.mark.parametrize("window", [3, 14, 35])
def test_equals_brute_force(spark, window):
    a, b, c = prose(1, 200), prose(2, 90), prose(3, 35)
    texts = [
        None, "", "   ", " ".join(a), " ".join(a), " ".join(b), " ".join(b[20:70] + c), "x" + " ".join(b[40:]), " ".join(c),
        " ".join(c[:34]), " ".join(c[:-1] + prose(9, 5)), "same " * 100, "same " * 36, "one\x0btwo\tthree four\x85five",
        " ".join(prose(4, 30) * 3), "ü" * 300, " ".join(prose(5, 300, 3)), " ".join(prose(6, 5000)), " ".join(prose(6, 5000)[17:4000]),
    ]
    got = by_id(substring_dedup(docs_of(spark, texts), window))
    want = plain(texts, window)
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) == w, texts[i]


def test_empty_table_clashing_columns_repeated_rows_and_null_ids(spark):
    docs = docs_of(spark, [])
    assert substring_dedup(docs).count() == 0
    text = " ".join(prose(7, 50))
    rows = [(1, text), (1, text), (2, " ".join(prose(8, 50))), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as row_key", "2 as anchors", "true as copied", "3 as n_words"
    )
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup(docs).collect())
    assert got == [(0, 50), (1, 50), (1, 50), (2, 0)]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = by_id(QUERIES["op3_substring_dedup"](spark, SMALL))
    for r, want in zip(rows, plain([r.text for r in rows], 35)):
        g = got[r.doc_id]
        assert (g.n_words, g.n_removed, g.kept_sha256) == want
