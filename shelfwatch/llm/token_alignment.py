"""Alignment of two tokenisations of the same texts by their byte offsets, and how often the tokens go together.

Both tokenizers read a blank and the text. All tokens of a block of documents lie on one byte axis; an as-of merge keyed
by document finds for every token start of one side the token of the other side that covers it, and the union of both
directions is every overlapping pair once. Pairs that end together are links and close a group. Each document's links
are kept as distinct id pairs with their number, the pairs are counted over the corpus, and the counts are brought back
by a join that is broadcast only where the counts were measured to be small.

Neither tokenizer joins anything across the end of a word before a blank, so words are tokenised one by one and every
distinct word of a worker once; a document longer than a block goes through in parts that end with a word.

Defined results: a null or empty text has no tokens, nor has one whose tokens of either side do not give back the blank
and the text (a literal U+2581, for one); such rows have zeros and an empty digest. Repeated rows are counted each, null
ids are kept, strings of special tokens are plain text, and columns other than the id and the text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved, small

BLOCK_WORDS = 200_000
WORDS_KEPT = 400_000
# New words that the byte-level tokenizer reads as one text.
WORDS_AT_ONCE = 200
# A pair is one long: the id of the first side in the upper half, of the second in the lower.
HALF = 32
_SPACE_BEFORE_BLANK = re.compile(r"\s ")
_WORD_END = re.compile(r"(?<=\S)(?= )")


# ---- tokens of words ----------------------------------------------------------------------------------------------


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies use for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        size = self.tokenizer.get_vocab_size()
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = [bytes(letters[c] for c in e) if all(c in letters for c in e) else b"" for e in entries]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, each with a blank before it, and how many each word has."""
        # Many words at once, as no token goes on over a blank after a letter; the few words that end in white space alone.
        alone = [not w or w[-1].isspace() for w in words]
        joined = [w for w, x in zip(words, alone) if not x]
        texts = [" " + " ".join(joined[at : at + WORDS_AT_ONCE]) for at in range(0, len(joined), WORDS_AT_ONCE)]
        ids = _flat([e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)])
        ends = np.cumsum([1 + len(w.encode()) for w in joined], dtype=np.int64)
        counts = np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), ends, "right"), prepend=0)
        if not any(alone):
            return ids, counts
        rest = [e.ids for e in self.tokenizer.encode_batch([" " + w for w, x in zip(words, alone) if x], add_special_tokens=False)]
        return _interleaved(np.array(alone), (ids, counts), (_flat(rest), np.array([len(r) for r in rest])))


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _interleaved(second: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of words that lie in two tables, by whether each word is in the second one."""
    counts = np.zeros(len(second), np.int64)
    counts[~second], counts[second] = a[1], b[1]
    ids, of = np.zeros(int(counts.sum()), np.int64), np.repeat(second, counts)
    ids[~of], ids[of] = a[0], b[0]
    return ids, counts


class Pieces:
    """A sentence-piece model, which puts a blank before what it reads."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(e[3:5], 16)]) if self.model.is_byte(i) else e.replace("▁", " ").encode() for i, e in enumerate(entries)
        ]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.blank = self.model.piece_to_id("▁")

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, each with a blank before it, and how many each word has."""
        found = [ids or [self.blank] for ids in self.model.encode(words, num_threads=1)]
        return _flat(found), np.fromiter(map(len, found), np.int64, len(found))


class Side:
    """Tokens of numbered words, in flat arrays that grow."""

    def __init__(self, model):
        self.model = model
        self.sizes = model.sizes
        width = len(str(max(1, len(self.sizes) - 1)))
        decimals = np.char.zfill(np.arange(len(self.sizes)).astype(str), width)
        # The ids in decimals, a column for the separator, and which of these characters are written.
        self.letters = np.zeros((len(self.sizes), width + 1), np.uint8)
        self.letters[:, :width] = decimals.astype(f"S{width}").view(np.uint8).reshape(-1, width)
        written = np.array([len(str(i)) for i in range(len(self.sizes))])
        self.shown = np.arange(width + 1) >= (width - written)[:, None]
        self.clear()

    def clear(self) -> None:
        self.ids = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def add(self, words: list[str]) -> np.ndarray:
        """Tokenises more words; tells which of them the tokens give back."""
        ids, counts = self.model.encode(words)
        self.ids = np.concatenate([self.ids, ids])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        parts = list(map(self.model.bytes.__getitem__, ids.tolist()))
        want = [(" " + w).encode() for w in words]
        ends = np.cumsum(counts)
        if b"".join(parts) == b"".join(want):
            # The same bytes in all: right word by word if every word has as many as it should.
            got = np.diff(np.concatenate([[0], np.cumsum(self.sizes[ids])])[ends], prepend=0)
            return got == np.fromiter(map(len, want), np.int64, len(want))
        return np.array([b"".join(parts[e - n : e]) == w for e, n, w in zip(ends.tolist(), counts.tolist(), want)])

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words' tokens one after the other, and how many each word has."""
        begin, counts = self.first[words], self.first[words + 1] - self.first[words]
        at = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        return self.ids[at], counts


class Words:
    """Numbers of words, and both sides' tokens of them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(ByteLevel(path_a)), Side(Pieces(path_b))
        self.clear()

    @classmethod
    @functools.cache
    def shared(cls, path_a: str, path_b: str) -> Words:
        """The one of this Python worker, which serves many tasks."""
        return cls(path_a, path_b)

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.whole = np.zeros(0, bool)
        self.a.clear()
        self.b.clear()

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.number) > WORDS_KEPT:
            self.clear()
        new = list(set(words).difference(self.number))
        if new:
            whole = self.a.add(new) & self.b.add(new)
            self.whole = np.concatenate([self.whole, whole])
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def words_of(text: str) -> list[str]:
    """The text cut before every blank that follows a character other than white space; each word has lost one blank."""
    text = " " + text
    if _SPACE_BEFORE_BLANK.search(text) is None:
        return text[1:].split(" ")
    return [w[1:] for w in _WORD_END.split(text)]


# ---- alignment ----------------------------------------------------------------------------------------------------


@dataclass
class Tokens:
    """Tokens of one side of some documents: ids, documents in ascending order, places on the common byte axis."""

    id: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, side: Side, words: np.ndarray, doc_of_word: np.ndarray) -> Tokens:
        ids, counts = side.of(words)
        end = np.cumsum(side.sizes[ids])
        return cls(ids, np.repeat(doc_of_word, counts), end - side.sizes[ids], end)


def covering(starts: Tokens, other: Tokens) -> np.ndarray:
    """For each token, the number of the other side's token that covers its first byte."""
    left = pd.DataFrame({"at": starts.start, "doc": starts.doc})
    right = pd.DataFrame({"at": other.start, "doc": other.doc, "token": np.arange(len(other.id))})
    return pd.merge_asof(left, right, on="at", by="doc")["token"].to_numpy().astype(np.int64)


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of tokens that share bytes, once."""
    if not len(a.id) or not len(b.id):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b_at_a, a_at_b = covering(a, b), covering(b, a)
    more = a.start[a_at_b] != b.start  # pairs that start together are in the first direction already
    return np.concatenate([np.arange(len(a.id)), a_at_b[more]]), np.concatenate([b_at_a, np.flatnonzero(more)])


def group_text(a: Side, b: Side, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray):
    """`a1,a2|b1;a3|b2,b3;` for the groups that end with these tokens, and where each group ends in it."""
    closes_a, closes_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    closes_a[last_a], closes_b[last_b] = True, True
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    place_a = np.arange(len(ids_a)) + np.concatenate([[0], last_b + 1])[group_a]
    place_b = np.arange(len(ids_b)) + (last_a + 1)[group_b]
    width = max(a.letters.shape[1], b.letters.shape[1])
    letters, shown = np.zeros((len(ids_a) + len(ids_b), width), np.uint8), np.zeros((len(ids_a) + len(ids_b), width), bool)
    for side, ids, place, closes, mark in ((a, ids_a, place_a, closes_a, "|"), (b, ids_b, place_b, closes_b, ";")):
        part = side.letters[ids]
        part[:, -1] = np.where(closes, ord(mark), ord(","))
        letters[place, width - part.shape[1] :] = part
        shown[place, width - part.shape[1] :] = side.shown[ids]
    ends = np.cumsum(shown.sum(axis=1))
    return letters[shown].tobytes(), ends[place_b[last_b]]


@dataclass
class Found:
    """What is known of a document so far."""

    whole: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    n_overlaps: int = 0
    digest: object = field(default_factory=hashlib.sha256)
    pairs: list = field(default_factory=list)

    def result(self) -> tuple:
        if not self.whole or not self.n_a:
            return (0, 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        pairs, numbers = (np.concatenate([p[k] for p in self.pairs]) for k in (0, 1))
        if len(self.pairs) > 1:
            pairs, at = np.unique(pairs, return_inverse=True)
            numbers = np.bincount(at, numbers).astype(np.int64)
        return (self.n_a, self.n_b, self.n_groups, self.n_links, self.n_overlaps, self.digest.hexdigest(), pairs, numbers)


def _blocks(texts: pa.Array) -> Iterator[list[tuple[int, list[str], bool]]]:
    """Parts of texts, of BLOCK_WORDS words together: number of the text, words, and whether the text ends."""
    held, size = [], 0
    for i, text in enumerate(texts):
        words = words_of(text.as_py()) if text.is_valid and len(text.as_py()) else []
        at = 0
        while True:
            part = words[at : at + BLOCK_WORDS - size]
            at += len(part)
            size += len(part)
            held.append((i, part, at == len(words)))
            if size == BLOCK_WORDS:
                yield held
                held, size = [], 0
            if at == len(words):
                break
    if held:
        yield held


def _aligned(known: Words, block: list[tuple[int, list[str], bool]], found: dict[int, Found]) -> None:
    """Adds what the block's parts hold to their documents."""
    numbers = known.of([w for _, words, _ in block for w in words])
    counts = np.array([len(words) for _, words, _ in block])
    part_of = np.repeat(np.arange(len(block)), counts)
    whole = np.bincount(part_of, ~known.whole[numbers], len(block)) == 0
    good = whole[part_of]
    numbers, part_of = numbers[good], part_of[good]
    a, b = Tokens.of(known.a, numbers, part_of), Tokens.of(known.b, numbers, part_of)
    in_a, in_b = overlaps(a, b)
    together = a.end[in_a] == b.end[in_b]
    last_a, last_b = np.sort(in_a[together]), np.sort(in_b[together])  # both in the order of their common ends
    text, ends = group_text(known.a, known.b, a.id, b.id, last_a, last_b)
    per = lambda docs: np.bincount(docs, minlength=len(block))
    n_a, n_b, n_links, n_overlaps = per(a.doc), per(b.doc), per(a.doc[last_a]), per(a.doc[in_a])
    first = np.concatenate([[0], np.cumsum(n_links)])
    ends = np.concatenate([[0], ends])
    key = (a.id[last_a] << HALF) | b.id[last_b]
    for k, (i, _, _) in enumerate(block):
        doc = found.setdefault(i, Found())
        doc.whole &= bool(whole[k])
        if not doc.whole or not n_a[k]:
            continue
        if doc.n_a:
            doc.digest.update(b";")
        doc.digest.update(text[ends[first[k]] : ends[first[k + 1]] - 1])
        doc.n_a += int(n_a[k])
        doc.n_b += int(n_b[k])
        doc.n_groups += int(n_links[k])
        doc.n_links += int(n_links[k])
        doc.n_overlaps += int(n_overlaps[k])
        doc.pairs.append(np.unique(key[first[k] : first[k + 1]], return_counts=True))


ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, "
    "pairs array<struct<pair: long, n: long>>"
)


def _rows(path_a: str, path_b: str):
    def rows(batches):
        known = Words.shared(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            found: dict[int, Found] = {}
            for block in _blocks(texts):
                _aligned(known, block, found)
                done = [i for i, _, last in block if last]
                if done:
                    yield _batch(row, ids.take(pa.array(done)), [found.pop(i).result() for i in done])
                    row += len(done)

    return rows


def _batch(row: int, ids: pa.Array, results: list[tuple]) -> pa.RecordBatch:
    *plain, pairs, numbers = zip(*results)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32)
    links = pa.StructArray.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (pairs, numbers)], ["pair", "n"])
    columns = [pa.array(range(row, row + len(results)), pa.int64()), ids]
    columns += [pa.array(p, pa.int64()) for p in plain[:-1]] + [pa.array(plain[-1], pa.string()), pa.ListArray.from_arrays(offsets, links)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")[:8]] + ["pairs"])


# ---- operator -----------------------------------------------------------------------------------------------------


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: numbers of tokens, groups, links and overlaps, the groups' digest, and the linked id pairs."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_rows(path_a, path_b), ALIGNED)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, a_id, b_id, count over all documents, and whether no pair of the same second id has a higher one."""
    counts = found.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("count"))
    counts = saved(counts, "alignment-counts").withColumns(
        {"a_id": F.shiftright("pair", HALF), "b_id": F.col("pair").bitwiseAND(F.lit((1 << HALF) - 1))}
    )
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b_id").select("pair", "a_id", "b_id", "count", (F.col("count") == F.col("highest")).alias("best"))


def token_alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups_sha256."""
    found = saved(aligned(docs, path_a, path_b, id_col, text_col), "alignment")
    counts = small(saved(pair_counts(found).select("pair", "count", "best"), "alignment-pairs"))
    links = found.select("row", F.inline("pairs")).join(counts, "pair")
    sums = links.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")
    )
    whole = found.drop("pairs").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
