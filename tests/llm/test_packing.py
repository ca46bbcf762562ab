import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwatch.llm import packing
from shelfwatch.llm.packing import Search, WordIds, best_fit, pack, pack_documents, pack_sequences
from shelfwatch.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import docs_of, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "<|endoftext|> a<|startoftext|>b", "don't I'LL 12́", "a b c\x1cd\x85e\t\tf", "İSTANBUL ΣΑΣ ΑΣ Å ́x \ńy", "  ", "\n", "",
    "日本語 текст 🎉🎉 é ≠ = ̸", "a  b\r\nc\x0b\x0cd", "x" * 5000, "ſtraße K ﬁ", "a b c",
]


def direct(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [np.array(e.ids + [0], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, texts, length, first=0):
    """The contract on all rows; returns the number of sequences."""
    want = {}
    for i, ids in enumerate(direct(texts)):
        for k, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            want[first + i, k] = (at, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= length
    return len(by), -(-sum(n for _, n, _ in want.values()) // length)


def test_words_give_the_ids_of_whole_texts():
    texts = ODD + [" ".join(prose(k, 50)) + ", it's.\n" for k in range(20)]
    assert [np.frombuffer(b, "<u4").tolist() for b in WordIds(PATH).of(texts)] == [d.tolist() for d in direct(texts)]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_gives_its_ids(text):
    assert np.frombuffer(WordIds.shared(PATH).of([text])[0], "<u4").tolist() == direct([text])[0].tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 99), min_size=1, max_size=80))
def test_search_keeps_pieces_and_never_loses(sizes):
    sizes = np.array(sizes)
    bins = pack(sizes, 100)
    assert sorted(sum(bins, [])) == list(range(len(sizes)))
    assert max(sizes[b].sum() for b in bins) <= 100 and len(bins) <= len(best_fit(sizes, 100))


def test_each_step_raises_the_squared_fills():
    sizes = np.random.default_rng(1).integers(500, 800, 300)
    search = Search(sizes, best_fit(sizes, 2048), 2048)
    source = int(np.argmin(search.fill))
    for _ in range(20):
        before = (search.fill**2).sum()
        if not search.fill[source] or not search._step(source):
            break
        assert (search.fill**2).sum() > before
        assert all(search.fill[i] == sizes[b].sum() for i, b in enumerate(search.bins))
    assert len(search.run()) < len(best_fit(sizes, 2048))


@pytest.mark.parametrize("group", [7, 40_000])
def test_documents(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_PIECES", group)
    texts = [None, *ODD, " ".join(prose(1, 9000)), *(" ".join(prose(k, 3 + 7 * (k % 90))) for k in range(300))]
    rows = pack_documents(docs_of(spark, texts), PATH, 2048).collect()
    used, least = check(rows, texts, 2048)
    if group > 7:
        assert used <= least + 1


def test_ids_are_kept_when_asked_for(spark):
    rows = pack_documents(docs_of(spark, ["one two", " ".join(prose(2, 3000))]), PATH, 512, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_empty_repeated_rows_null_ids_clashing_columns(spark):
    assert pack_documents(docs_of(spark, []), PATH).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string").selectExpr("*", "1 as length", "2 as offset")
    rows = pack_documents(docs, PATH).collect()
    assert sorted((r.doc_id or 0, r.length, r.offset) for r in rows)[0][:2] == (0, 2) and len(rows) == 3
    assert sorted(r.offset for r in rows) in ([0, 2, 5], [0, 3, 5], [0, 3, 6], [0, 2, 4])
    assert pack_sequences(spark.createDataFrame([], "length long")).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    rows = QUERIES["op5_packing"](spark, SMALL).collect()
    used, least = check(rows, [d.text for d in docs], 2048, docs[0].doc_id)
    assert used <= least + 1
