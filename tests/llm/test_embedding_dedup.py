import numpy as np
import pytest

from shelfwatch.llm import embedding_dedup
from shelfwatch.llm.embedding_dedup import embedding_links
from shelfwatch.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.test_jaccard_join import roots

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.9):
    """Links counted and components by comparing all, in double precision."""
    ids = [i for i, _ in rows]
    ok = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.linalg.norm(np.array(v, float)) > 0]
    n, links = [0] * len(rows), []
    for x, a in enumerate(ok):
        for b in ok[:x]:
            if len(rows[a][1]) == len(rows[b][1]):
                u, v = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    links.append((ids[a], ids[b]))
    group = roots(ids, links)
    return {i: (n[k], group[i], group[i] == i) for k, i in enumerate(ids)}


def around(r, center, n, spread):
    return [(center + spread * r.standard_normal(len(center))).astype(np.float32).tolist() for _ in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    r = np.random.default_rng(3)
    vectors = [r.standard_normal(32).astype(np.float32).tolist() for _ in range(200)]
    for k in range(12):
        vectors += around(r, r.standard_normal(32), [2, 2, 2, 5, 9, 14, 20, 70, 3, 2, 2, 40][k], 0.12)
    vectors += [vectors[3]] * 30 + [[2 * x for x in vectors[4]]] + [vectors[250]] * 3
    vectors += [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0] * 8, [1.0] * 8, [3.0] * 8]
    rows = [(1000 - 2 * k, v) for k, v in enumerate(vectors)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).selectExpr("*", "1 as node", "2 as unit", "3 as component")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embedding_links(df).collect()}
    want = plain(rows)
    assert sum(got[i] != want[i] for i in want) <= 0.01 * len(want)
    assert all(got[i][0] <= want[i][0] for i in want)


def test_audit_asks_for_more(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TABLES", 1)
    monkeypatch.setattr(embedding_dedup, "WINDOW", 1)
    seen = []
    real = embedding_dedup.Descent.recall
    monkeypatch.setattr(embedding_dedup.Descent, "recall", lambda *a: seen.append(real(*a)) or seen[-1])
    r = np.random.default_rng(5)
    vectors = [v for _ in range(150) for v in around(r, r.standard_normal(24), 2, 0.13)]
    df = spark.createDataFrame([(k, v, 1) for k, v in enumerate(vectors)], SCHEMA)
    embedding_links(df).count()
    assert seen[0] < 1 and len(seen) > 1 and seen == sorted(seen)


def test_audit_draws_until_it_has_links(spark, monkeypatch):
    for name, value in (("TABLES", 1), ("WINDOW", 1), ("AUDITED", 2)):
        monkeypatch.setattr(embedding_dedup, name, value)
    monkeypatch.setattr(embedding_dedup.Descent, "join", lambda self: None)
    monkeypatch.setattr(embedding_dedup, "DRAWS", 20, raising=False)
    r = np.random.default_rng(7)
    vectors = r.standard_normal((400, 24)).astype(np.float32).tolist()
    vectors += [v for _ in range(25) for v in around(r, r.standard_normal(24), 2, 0.2)]
    rows = list(enumerate(vectors))
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embedding_links(df).collect()}
    want = plain(rows)
    assert sum(got[i][0] for i in want) >= 0.98 * sum(want[i][0] for i in want)


def test_fails_if_recall_stays_low(spark, monkeypatch):
    none = "a long, b long, similarity double"
    monkeypatch.setattr(embedding_dedup.Descent, "project", lambda self, seed: self.add(spark.createDataFrame([], none)))
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (3, [0.0, 1.0], 0)], SCHEMA)
    with pytest.raises(RuntimeError, match="recall"):
        embedding_links(df)


def test_projections_follow_the_nodes():
    rounds = [embedding_dedup.rounds_of_tables(n, 0.9) for n in (1, 10_000, 100_000, 1_000_000, 100_000_000)]
    assert rounds == [1, 1, 2, 4, 10] and embedding_dedup.rounds_of_tables(10**8, 1.0) == 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 0.0])], [(None, [1.0, 2.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0])]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in embedding_links(df).collect())
    want = {0: [], 1: [(1, 0, 1, True)], 3: [(-1, 2, -1, True), (4, 2, -1, False), (4, 2, -1, False)]}
    assert got == want[len(rows)]


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op1_embedding_dedup"](spark, SMALL).collect()}
    want = plain(rows)
    assert sum(got[i] != want[i] for i in want) <= 0.01 * len(want)
