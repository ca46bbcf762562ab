import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwatch.llm import language_id as op
from shelfwatch.llm.language_id import Automaton, fold, identify, learn, phrases, sample, suffix_automaton
from shelfwatch.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import DOCS, docs_of

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "gro", "ver"], "cc": ["éa", "ño", "ción", "ll"], "dd": ["щу", "ка", "мо", "ре"]}


def text_in(lang, seed, n=60):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def plain_phrases(text: bytes, known: bytes) -> int:
    """Greedy longest matches, found by looking through the known text."""
    n, total = 0, 0
    for at in range(0, len(text), op.STRETCH):
        part, n = text[at : at + op.STRETCH], 0
        while n < len(part):
            size = 1
            while n + size < len(part) and part[n : n + size + 1] in known:
                size += 1
            n, total = n + size, total + 1
    return total


def plain_fold(text: bytes) -> bytes:
    mapped = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text).lower()
    return b" ".join(p for p in mapped.split(b" ") if p) + (b" " if mapped.endswith(b" ") and mapped.strip() else b"")


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_automaton_reads_the_substrings(text):
    goes = suffix_automaton(text)
    want = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)} | {b""}
    seen, todo = set(), [(0, b"")]
    while todo:
        state, word = todo.pop()
        seen.add(word)
        todo += [(t, word + bytes([c])) for c, t in goes[state].items()]
    assert seen == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abc é!1", max_size=30), max_size=8), st.text(alphabet="abcé ", max_size=200), st.sampled_from([512, 7]))
def test_phrases_equal_brute_force(texts, known, stretch):
    before, op.STRETCH = op.STRETCH, stretch
    try:
        raw = [t.encode() for t in texts]
        data, first = fold(raw)
        folded = [data[a:b].tobytes() for a, b in zip(first, first[1:])]
        assert folded == [plain_fold(t) for t in raw]
        automata = [Automaton(*Automaton.of(k)) for k in (known.encode(), b"")]
        want = [[plain_phrases(t, k) for t in folded] for k in (known.encode(), b"")]
        assert phrases(data, first, automata).tolist() == want
    finally:
        op.STRETCH = before


def test_sample_is_the_least_of_all_pieces(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECES", 20)
    docs = docs_of(spark, [text_in("aa", k, 200) for k in range(60)] + [text_in("aa", 1, 200)] * 40).withColumn("lang", F.lit("aa"))
    import xxhash

    pieces = set()
    for k in range(60):
        folded = plain_fold(text_in("aa", k, 200).encode())
        pieces |= {folded[i : i + op.PIECE_BYTES] for i in range(0, len(folded), op.PIECE_BYTES)}
    want = sorted(pieces, key=xxhash.xxh3_64_intdigest)[:20]
    got = sample(docs.repartition(7)).orderBy("hash").collect()
    assert [bytes(r.piece) for r in got] == want


@pytest.mark.parametrize("at_once", [16, 1])
def test_learns_and_predicts(spark, monkeypatch, at_once):
    monkeypatch.setattr(op, "LANGUAGES_AT_ONCE", at_once)
    rows = [(k, text_in(lang, k), lang, "s", 1) for k, lang in enumerate(random.Random(1).choices(list(SYLLABLES), [9, 2, 2, 1], k=400))]
    found = {r.doc_id: r for r in identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    assert all(found[i].lang_pred == lang and 0 < found[i].score <= 1 for i, _, lang, *_ in rows)


def test_held_out_labels_and_columns_have_no_effect(spark):
    rows = [(k, text_in("aa" if k % 2 else "bb", k), "aa" if k % 2 else "bb", "s", 1) for k in range(90)]
    out = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    wrong = [(i, t, "zz" if i in out else lang, "other" if i in out else s, n) for i, t, lang, s, n in rows]
    one, two = (sorted(tuple(r) for r in identify(spark.createDataFrame(x, DOCS)).collect()) for x in (rows, wrong))
    assert one == two and not any(r[2] == "zz" for r in one)


def test_odd_rows(spark):
    odd = [(900, None, "aa", None, 1), (901, "", "aa", None, 1), (902, "123 !?", None, None, 1), (None, text_in("bb", 5), "bb", None, 1), (903, "é", None, None, 1), (904, text_in("aa", 1, 60_000), None, "s", 1)]
    rows = [(k, text_in("aa" if k % 2 else "bb", k), "aa" if k % 2 else "bb", "s", 1) for k in range(40)]
    docs = spark.createDataFrame(rows + odd + [rows[0], rows[0]], DOCS).withColumns({"best": F.lit(1), "hash": F.lit(2), "lettered": F.lit("x"), "rows": F.lit(0)})
    found = identify(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == 48
    by = {r.doc_id: r for r in found.collect()}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert (by[None].lang_pred, by[None].held_out) == ("bb", False) and by[904].lang_pred == "aa" and by[903].lang_pred in ("aa", "bb")
    assert [r.lang_pred for r in identify(docs.filter("doc_id = 0")).collect()] in (["bb"] * 3, ["und"] * 3)


def test_nothing_learnt_and_empty(spark):
    assert identify(docs_of(spark, [])).count() == 0
    rows = identify(docs_of(spark, ["some text", None]).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 2
    assert learn(docs_of(spark, ["abc"]).select("lang", "text")).collect()[0]["size"] == 3


def test_query_is_right_on_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_language_id"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    right = collections.Counter((docs[r.doc_id].lang, r.lang_pred == docs[r.doc_id].lang) for r in rows if r.held_out)
    for lang in {lang for lang, _ in right}:
        assert right[lang, True] >= 0.95 * (right[lang, True] + right[lang, False])
    assert np.mean([r.score for r in rows]) > 0.3
