import hashlib
import re

import pytest

from shelfwatch.llm.decontaminate import decontaminate
from shelfwatch.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import by_id, docs_of, prose

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(texts, items, window):
    at = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            at.setdefault(tuple(w[j : j + k]), set()).add(i)
    sizes = {len(k) for k in at}
    out = []
    for t in texts:
        w = words(t)
        hit, found = [0] * len(w), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if ids := at.get(tuple(w[j : j + k])):
                    hit[j : j + k] = [1] * k
                    found |= ids
        n = sum(hit)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((len(w), n, ids, n > 0 and 20 * n >= len(w)))
    return out


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "item_id long, text string, shingles string")


@pytest.mark.parametrize("per_block", [7, 10000])
def test_equals_brute_force(spark, per_block):
    a, b = prose(1, 40), prose(2, 25)
    items = [" ".join(a), " ".join(b), "Short, item!", "one", "", None, "...", " ".join(a[5:30]), "same " * 14, "Ünïcode ÄÖ ß wörd"]
    texts = [
        None, "", "-- ..", " ".join(a).upper(), "x " * 300 + " ".join(a[3:17]), " ".join(a[3:15]) + " stop " + " ".join(a[15:27]),
        "a short ITEM here", "short", "one", "ones", "zero one", "same " * 12, "same " * 13, "same " * 50, " ".join(prose(3, 20000)),
        " ".join(b[:13] + b[:13]), "Ünïcode äö ß wörd", "Ünïcode ÄÖ ß wörd!", " ".join(b) + " " + " ".join(a), "y" * 100000,
        " ".join(a[3:16]) + "\n" + " ".join(prose(5, 247)), " ".join(a[3:16]) + "\n" + " ".join(prose(5, 248)),
    ]
    got = by_id(decontaminate(docs_of(spark, texts), items_of(spark, items), 13, per_block=per_block))
    for i, want in enumerate(plain(texts, list(enumerate(items)), 13)):
        r = got[i]
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == want, texts[i]
        assert sum(b - a for a, b in r.spans) == r.n_hit


def test_empty_tables_repeated_rows_null_ids(spark):
    a = " ".join(prose(1, 30))
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate(docs_of(spark, [a]), none).collect()] == [0]
    assert decontaminate(docs_of(spark, []), items_of(spark, [a])).count() == 0
    docs = spark.createDataFrame([(1, a), (1, a), (None, a)], "doc_id long, text string").selectExpr("*", "1 as spans", "2 as window")
    items = spark.createDataFrame([(None, a), (3, a), (3, a)], "item_id long, text string")
    got = [(r.n_hit, r["items"], r.contaminated) for r in decontaminate(docs, items).collect()]
    assert got == [(30, ["3"], True)] * 3


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = by_id(QUERIES["op6_decontaminate"](spark, SMALL))
    want = plain([d.text for d in docs], items, 13)
    assert any(w[1] for w in want)
    for d, (n_words, n_hit, ids, bad) in zip(docs, want):
        r = got[d.doc_id]
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n_words, n_hit, len(ids), digest, bad)
