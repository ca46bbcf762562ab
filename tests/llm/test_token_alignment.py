import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwatch.llm import token_alignment as op
from shelfwatch.llm.queries import QUERIES
from shelfwatch.llm.token_alignment import ByteLevel, Pieces, Words, token_alignment, words_of
from tests.conftest import SMALL
from tests.llm.helpers import docs_of, prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a", " ", "  ", "\n", "a ", "a  b", " a\n b", "a \n", "x\x1c y", "\x00a", "a▁b", "▁", "<|endoftext|> b", "<s> </s><unk> <0x41>", "日本語 текст 🎉🎉 é",
    "don't I'LL we've", "a  b c  d", "ﬁ ſ K Å", "a​ b﻿", "x" * 3000, "a\r\n\tb   c", "ab᠎ c",
]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens(text):
    """Ids and byte ends of both sides, from the whole text; None without tokens."""
    if not text:
        return None
    whole = (" " + text).encode()
    a = Tokenizer.from_file(PATHS[0]) if not hasattr(tokens, "a") else tokens.a
    tokens.a, tokens.b = a, getattr(tokens, "b", None) or sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = op.byte_of_letter()
    out = []
    for ids, piece in (
        (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(letters[c] for c in a.id_to_token(i))),
        (tokens.b.encode(text), lambda i: bytes([int(tokens.b.id_to_piece(i)[3:5], 16)]) if tokens.b.is_byte(i) else tokens.b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        if b"".join(map(piece, ids)) != whole:
            return None
        ends, end = [], 0
        for i in ids:
            end += len(piece(i))
            ends.append((i, end))
        out.append(ends)
    return out


def plain(texts):
    links, groups = [], []
    for text in texts:
        found = tokens(text)
        if found is None:
            links.append(None)
            groups.append([])
            continue
        a, b = found
        links.append([(i, j) for i, x in a for j in [{y: j for j, y in b}.get(x)] if j is not None])
        common = sorted({x for _, x in a} & {y for _, y in b})
        parts, before = [], 0
        for end in common:
            parts.append("|".join(",".join(str(i) for i, x in side if before < x <= end) for side in (a, b)))
            before = end
        groups.append(parts)
    counts = collections.Counter(p for found in links for p in found or [])
    best = collections.defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for text, found, parts in zip(texts, links, groups):
        if found is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = tokens(text)
        n_best = sum(counts[p] == best[p[1]] for p in found)
        out.append((len(a), len(b), len(parts), len(found), n_best, sum(counts[p] for p in found), hashlib.sha256(";".join(parts).encode()).hexdigest()))
    return out


def got(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("block,kept", [(200_000, 400_000), (3, 10)])
def test_equals_brute_force(spark, monkeypatch, block, kept):
    monkeypatch.setattr(op, "BLOCK_WORDS", block)
    monkeypatch.setattr(op, "WORDS_KEPT", kept)
    texts = [None, "", *ODD, " ".join(prose(1, 900)), *(" ".join(prose(k, 5 + k % 60)) + ".\n" for k in range(60))]
    assert got(token_alignment(docs_of(spark, texts), *PATHS)) == plain(texts)


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=" \n\tab.'▁é日1", max_size=40)))
def test_words_give_the_tokens_of_whole_texts(text):
    found = tokens(text)
    if found is None:
        return
    known = Words.shared(*PATHS)
    numbers = known.of(words_of(text))
    assert known.whole[numbers].all()
    assert known.a.of(numbers)[0].tolist() == [i for i, _ in found[0]]
    assert known.b.of(numbers)[0].tolist() == [i for i, _ in found[1]]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abé日 \n🎉", min_size=1, max_size=40))
def test_overlaps_are_all_pairs_that_share_bytes(text):
    known = Words.shared(*PATHS)
    numbers = known.of(words_of(text))
    numbers = numbers[known.whole[numbers]]
    a, b = (op.Tokens.of(side, numbers, numbers * 0) for side in (known.a, known.b))
    want = {(i, j) for i in range(len(a.id)) for j in range(len(b.id)) if a.start[i] < b.end[j] and b.start[j] < a.end[i]}
    found = list(zip(*(x.tolist() for x in op.overlaps(a, b))))
    assert len(found) == len(set(found)) and set(found) == want


def test_vocabularies_give_back_their_bytes():
    byte, pieces = ByteLevel(PATHS[0]), Pieces(PATHS[1])
    assert sorted(b for b in byte.bytes if len(b) == 1) == [bytes([k]) for k in range(256)]
    # Words may be tokenised one by one because no piece goes on over a blank.
    for entries in (byte.bytes, pieces.bytes):
        entries = [e.decode(errors="replace") for e in entries]
        assert not any(y == " " and not x.isspace() for e in entries for x, y in zip(e, e[1:]))


def test_lookup_beyond_the_broadcast_bound_gives_the_same(spark, monkeypatch):
    texts = [" ".join(prose(k, 40, 50)) for k in range(20)]
    monkeypatch.setattr("shelfwatch.llm.tables.BROADCAST_BYTES", 0)
    assert got(token_alignment(docs_of(spark, texts), *PATHS)) == plain(texts)


def test_empty_repeated_rows_null_ids_clashing_columns(spark):
    assert token_alignment(docs_of(spark, []), *PATHS).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    docs = docs.withColumns({"row": F.lit(1), "pairs": F.lit("x"), "n_a": F.lit(2), "pair": F.lit(3)})
    rows = token_alignment(docs, *PATHS).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.n_b) for r in rows) == [(0, 1, 1), (1, 2, 2), (1, 2, 2)]
    assert {r.count_sum for r in rows} == {1, 4}


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    assert got(QUERIES["op12_token_alignment"](spark, SMALL)) == plain([d.text for d in docs])
