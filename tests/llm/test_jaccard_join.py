import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwatch.llm import jaccard_join
from shelfwatch.llm.components import components
from shelfwatch.llm.jaccard_join import EDGES, Segments, Sets, band_of, differences, jaccard_components, segments_of
from shelfwatch.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import by_id, docs_of, prose

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, n=5):
    w = (text or "").translate(LOWER).encode().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def plain(ids, texts, percent=75):
    sets = [shingles(t) for t in texts]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    links.append((ids[i], ids[j]))
    group = roots(ids, links)
    return {i: (len(s), group[i]) for i, s in zip(ids, sets)}


def edited(words, seed, n):
    r = random.Random(seed)
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"z{r.randrange(10**6)}"
    return out


def check(spark, texts, first=0):
    got = by_id(jaccard_components(docs_of(spark, texts, first)))
    want = plain(list(range(first, first + len(texts))), texts)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want


def corpus(seed):
    r = random.Random(seed)
    passage = prose(seed + 1, 60)
    texts = [None, "", " \n", "a b", "A b", "a b c d e", "a b c d e f", "x " * 50, "x " * 80, "ü Ü ü Ü ü", "Ü ü ü Ü ü"]
    for k in range(12):
        base = prose(seed * 100 + k, r.choice([6, 9, 20, 60, 200, 700]))
        texts.append(" ".join(base))
        for e in range(r.randrange(12)):
            w = edited(base, seed * 1000 + k * 50 + e, r.randrange(1 + len(base) // 12))
            texts.append(" ".join(w[r.randrange(3) : len(w) - r.randrange(3)]))
    for k in range(40):  # a passage that many share, on its own no link
        texts.append(" ".join(passage + prose(seed * 7 + k, r.choice([10, 14, 30, 80]))))
    chain = prose(seed + 5, 100)
    for k in range(8):  # each links with the next one only
        texts.append(" ".join(chain[k * 9 : k * 9 + 70] if k else chain[:70]))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    check(spark, corpus(seed), first=seed * 10)


def test_common_shingles_and_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr("shelfwatch.llm.tables.BROADCAST_BYTES", -1)
    passage = prose(3, 120)
    texts = [" ".join(passage[: 100 + k % 20] + prose(900 + k, 20 + k % 50)) for k in range(60)]
    check(spark, texts + [" ".join(edited(passage, k, 3)) for k in range(60)])


def test_all_sizes_have_enough_segments():
    size = np.arange(1, 5000)
    band = band_of(size)
    assert (EDGES[band] <= size).all() and (size < EDGES[band + 1]).all()
    for other in (size, size * 100 // 75):
        assert (segments_of(band, 0 * band, 75) > differences(size, other, 75)).all()


def test_allocation_gives_the_units():
    sets = Sets([" ".join(prose(k, 40 + 30 * k)).encode() for k in range(20)], 5)
    docs = np.arange(20)
    common = np.arange(len(sets.value)) % 3 > 0
    seen = Segments(sets, docs, band_of(sets.size), np.zeros(20, int), 75, common)
    differ = differences(sets.size, sets.size, 75)
    exact, near, shared = seen.allocate(differ)
    assert near.any() and (seen._count(exact) + 2 * seen._count(near) > differ).all() and (shared >= 1).all()


def test_sketches_never_rule_out_a_link(spark):
    base = prose(1, 400)
    texts = [" ".join(edited(base, k, k)) for k in range(20)] + [" ".join(base[: 300 + 5 * k]) for k in range(20)]
    sets = Sets([t.encode() for t in texts], 5)
    rows = list(zip(range(len(texts)), sets.size.tolist(), sets.sketches().to_pylist()))
    df = spark.createDataFrame(rows, "i long, size long, sketch array<long>")
    pairs = df.toDF("i", "m", "s").crossJoin(df.toDF("j", "n", "t"))
    fits = jaccard_join.may_link(F.col("s"), F.col("t"), F.col("m"), F.col("n"), 75)
    held = [shingles(t) for t in texts]
    few = 0
    for r in pairs.select("i", "j", fits.alias("fits")).collect():
        a, b = held[r.i], held[r.j]
        if 100 * len(a & b) >= 75 * len(a | b):
            assert r.fits
        elif not r.fits:
            few += 1
    assert few > 100


def test_a_pair_is_compared_in_one_of_the_large_keys(spark, monkeypatch):
    """Sets that share a passage and do not link met in every key of it, hundreds of times a pair."""
    passage = prose(3, 90)
    texts = [" ".join(passage + prose(700 + k, 17 + k % 3)) for k in range(80)]
    met, real = [], jaccard_join.Join.meetings

    def meetings(*args):
        found = real(*args).localCheckpoint()
        met.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(jaccard_join.Join, "meetings", meetings)
    monkeypatch.setattr(jaccard_join.Join, "fits", lambda self: F.lit(True))
    check(spark, texts)
    assert max(met)[0] > 1000 and all(n == different for n, different in met)


def test_bits_below_a_place(spark):
    join = object.__new__(jaccard_join.Join)
    n = jaccard_join.LARGE_KEYS // 64
    df = spark.range(jaccard_join.LARGE_KEYS + 1).withColumnRenamed("id", "place")
    for r in df.select("place", *(join.below(F.col("place"), i) for i in range(n))).collect():
        assert sum((x % 2**64) << (64 * i) for i, x in enumerate(r[1:])) == (1 << r.place) - 1


def test_empty_repeated_null_ids_and_clashing_columns(spark):
    assert jaccard_components(docs_of(spark, [])).count() == 0
    text = " ".join(prose(1, 20))
    rows = [(5, text), (5, text), (7, text + " more"), (8, None), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as size", "2 as key", "3 as set_id")
    got = sorted(tuple(-1 if x is None else x for x in r) for r in jaccard_components(docs).collect())
    assert got == [(-1, 1, -1), (5, 16, 5), (5, 16, 5), (7, 17, 5), (8, 0, 8)]


def test_components_of_paths_and_stars(spark):
    r = random.Random(4)
    nodes = list(range(400))
    names = r.sample(range(10**6), 400)
    links = [(i, i + 1) for i in range(150)] + [(200, i) for i in range(201, 300)] + [(i, r.randrange(300, 400)) for i in range(300, 330)]
    links = [(names[a], names[b]) for a, b in links]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    want = roots([names[n] for n in nodes], links)
    touched = {x for l in links for x in l if l[0] != l[1]}
    assert got == {n: want[n] for n in touched}


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = by_id(QUERIES["op7_jaccard_join"](spark, SMALL))
    want = plain([r.doc_id for r in rows], [r.text for r in rows])
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
