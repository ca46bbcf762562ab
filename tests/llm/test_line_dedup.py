import hashlib
import re

from shelfwatch.llm.line_dedup import BACK, CUT_ONE_IN, line_dedup
from tests.llm.helpers import by_id, docs_of, prose


def chunks(text):
    out, chunk, before = [], [], 0
    for line in text.split("\n"):
        h = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
        chunk.append(line)
        if (h + BACK * before) % CUT_ONE_IN == 0:
            out.append(chunk)
            chunk = []
        before = h
    return out + [chunk] if chunk else out


def plain(texts):
    seen, out = set(), []
    for t in texts:
        kept = []
        for c in chunks(t) if t else []:
            key = tuple(c)
            if len(c) > 1 and re.search(r"[^ \t\n\x0b\f\r]", "\n".join(c)):
                if key in seen:
                    continue
                seen.add(key)
            kept += c
        out.append("\n".join(kept) if t else t)
    return out


def block(seed, n):
    return [" ".join(prose(seed * 100 + i, 6)) for i in range(n)]


def test_equals_brute_force(spark):
    shared = block(1, 30)
    texts = [
        "\n".join(shared), "\n".join(block(2, 3) + shared + block(3, 4)), "\n".join(shared), None, "", "\n\n\n\n", "\n\n\n\n",
        "one line", "one line", "\n".join(block(4, 5) + shared[7:] + [""]), "\n".join(["same"] * 40), "\n".join(["same"] * 41),
        "\r\n".join(shared), "a" * 200000 + "\n" + "\n".join(block(5, 900)), "\n".join(block(5, 900)[300:]), " \n \t\n", " \n \t\n",
    ]
    got = by_id(line_dedup(docs_of(spark, texts)))
    want = plain(texts)
    for i, t in enumerate(texts):
        assert got[i].kept_text == want[i]
        assert got[i].n_lines == (len(t.split("\n")) if t else 0)
        if t:
            assert got[i].n_chunks == len(chunks(t))
    assert got[1].n_removed > 0 and got[9].n_removed > 0


def test_boundaries_resist_a_shift():
    long = block(6, 60)
    assert chunks("\n".join(long))[3:] == chunks("\n".join(block(7, 2) + long))[-len(chunks("\n".join(long))[3:]) :]


def test_empty_table_clashing_columns_repeated_rows_null_ids(spark):
    assert line_dedup(docs_of(spark, [])).count() == 0
    text = "\n".join(block(8, 20))
    rows = [(None, text), (1, text), (1, text), (2, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as lines", "2 as chunk", "3 as digest")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.kept_text == text) for r in line_dedup(docs).collect())
    assert got == [(-1, True), (1, False), (1, False), (2, False)]


def test_rows_that_share_an_id_but_not_the_text(spark):
    own = ["\n".join(block(k, 20)) for k in range(20, 24)]
    rows = [(1, own[0]), (None, own[1]), (None, own[2]), (2, own[0]), (2, own[1]), (2, own[3]), (2, own[3])]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), carry=["text"]).collect()
    kept = sorted((r.doc_id or 0, r.carried.text, r.kept_text == r.carried.text) for r in got)
    want = [(0, own[1], True), (0, own[2], True), (1, own[0], True), (2, own[0], False), (2, own[1], False), (2, own[3], True), (2, own[3], True)]
    assert kept == sorted(want)
    lines = {x for r in got for x in r.kept_text.split("\n")}
    assert lines == {x for t in own for x in t.split("\n")}
