"""Removal of long word sequences that occur more than once, by difference-cover anchors.

Two windows of `window` equal words at any two places share an aligned anchor: positions are taken modulo a period, and
a difference cover has, for any two residues, a shift below the period that brings both into the cover. So only the
runs that begin at cover positions are hashed and counted, about a quarter of all positions. Where an anchor is seen
again, the match is extended: every window that holds it is hashed with 96 bits and counted over all documents.

Exact copies are recognised by their digest first: all their windows repeat, and only one copy's windows are counted.
Anchors and windows are added up before the shuffle, where a passage that many documents share is one row per task. When
they are looked up again, a hot one is one row per document beside the hundreds that every document has of its own.

Defined results: a null or empty text has no words; a text shorter than the window loses nothing; repeated rows are
copies of each other; a null id is kept like any other; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved
from shelfwatch.llm.words import SPACE, Words, runs, signed, text_blocks, words_of

# Perfect difference sets by their period.
COVERS = {
    1: [0],
    3: [0, 1],
    7: [0, 1, 3],
    13: [0, 1, 3, 9],
    21: [0, 1, 4, 14, 16],
    31: [0, 1, 3, 8, 12, 18],
}
SHORTEST_ANCHOR = 12
NO_ID = -(2**63)


def period_for(window: int) -> int:
    """The longest period that leaves anchors long enough to be rare."""
    return max(p for p in COVERS if p == 1 or window - p + 1 >= SHORTEST_ANCHOR)


def _inside(words: Words, values: np.ndarray, k: int) -> np.ndarray:
    """The places from which k words of the same text follow."""
    return np.flatnonzero(words.left()[: len(values)] >= k)


def anchors_of(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors, of texts that hold a whole window."""
    period = period_for(window)
    k = window - period + 1
    values = runs(words.hash, k)
    place = _inside(words, values, k)
    text = words.text_of()[place]
    in_text = place - words.first[text]
    covered = np.isin(in_text % period, COVERS[period]) & (words.counts[text] >= window)
    return place[covered], values[place[covered]]


def _anchor_rows(window: int):
    def rows(batches):
        for batch in batches:
            ids = batch.column("key").to_numpy()
            for begin, texts in text_blocks(batch):
                words = words_of(texts, SPACE)
                place, anchor = anchors_of(words, window)
                key = ids[begin + words.text_of()[place]]
                order = np.lexsort((anchor, key))
                key, anchor = key[order], anchor[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (anchor[1:] != anchor[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(key)))
                yield pa.RecordBatch.from_pydict(
                    {"anchor": signed(anchor[at]), "key": key[at], "times": np.minimum(times, 2).astype(np.int32)}
                )

    return rows


def _packed(batches):
    """Texts compressed for the shuffle, and with their hash."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = [pack.compress(t.as_py()) for t in batch.column("text").fill_null("").cast(pa.large_binary())]
        columns = [batch.column(c) for c in ("doc_id", "key", "hash")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], ["doc_id", "key", "hash", "packed"])


def _texts(batch):
    """The batch's texts again, one at a time."""
    unpack = zstandard.ZstdDecompressor()
    return (unpack.decompress(t.as_py()) for t in batch.column("packed"))


def _candidates(words: Words, anchors: np.ndarray, window: int) -> np.ndarray:
    """Places of the windows of a single text that hold one of the given anchors where its cover has them."""
    place, value = anchors_of(words, window)
    n = len(words.hash) - window + 1
    if n <= 0 or not len(place):
        return np.zeros(0, np.int64)
    seen = place[np.isin(signed(value), anchors)]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.maximum(seen - period_for(window) + 1, 0), 1)
    np.add.at(change, np.minimum(seen + 1, n), -1)
    return np.flatnonzero(np.cumsum(change[:n]) > 0)


def _window_rows(window: int):
    """(h1, h2, times, key): key is null where the window is known to repeat already."""

    def rows(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            lists, copied, first = (batch.column(c) for c in ("anchors", "copied", "first"))
            for i, text in enumerate(_texts(batch)):
                is_copy = copied[i].as_py()
                if is_copy and not first[i].as_py() or not is_copy and not lists[i].is_valid:
                    continue
                words = words_of([text], SPACE)
                one = runs(words.hash, window)
                place = np.arange(len(one)) if is_copy else _candidates(words, lists[i].values.to_numpy(), window)
                if not len(place):
                    continue
                other = runs(words_of([text], SPACE, seed=2).hash, window)
                _, at, times = np.unique(one[place], return_index=True, return_counts=True)
                place = place[at]
                known = (times > 1) | is_copy
                yield pa.RecordBatch.from_pydict(
                    {
                        "h1": signed(one[place]),
                        "h2": (other[place] >> np.uint64(32)).astype(np.uint32).view(np.int32),
                        "times": np.where(known, 2, 1).astype(np.int32),
                        "key": pa.array(np.full(len(place), keys[i]), mask=known),
                    }
                )

    return rows


def _kept_rows(window: int):
    def rows(batches):
        for batch in batches:
            lists, copied, again = (batch.column(c) for c in ("anchors", "copied", "again"))
            kept, n_words, n_removed = [], [], []
            for i, text in enumerate(_texts(batch)):
                split = text.split()
                gone = np.zeros(len(split) + 1, np.int64)
                if copied[i].as_py():
                    gone[0] = len(split) >= window
                elif lists[i].is_valid and len(split) >= window:
                    words = words_of([text], SPACE)
                    place = _candidates(words, lists[i].values.to_numpy(), window)
                    value = runs(words.hash, window)[place]
                    _, which, times = np.unique(value, return_inverse=True, return_counts=True)
                    hit = times[which] > 1
                    if again[i].is_valid:
                        hit |= np.isin(signed(value), again[i].values.to_numpy())
                    np.add.at(gone, place[hit], 1)
                    np.add.at(gone, place[hit] + window, -1)
                keep = np.cumsum(gone[: len(split)]) == 0
                n_words.append(len(split))
                n_removed.append(int(len(split) - keep.sum()))
                left = split if keep.all() else [split[k] for k in np.flatnonzero(keep)]
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_removed": pa.array(n_removed, pa.int64()),
                    "kept_text": pa.array(kept, pa.string()),
                }
            )

    return rows


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (the words left, joined by one space).

    A word goes if a window of `window` words that covers it also starts anywhere else, in the same document or
    another. Words are runs of characters other than ASCII white space. All judged on the input, not on what is left.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # What is found is looked up by id; texts that share an id tell by their own anchors and hashes what is theirs.
    docs = docs.withColumn("key", F.coalesce("doc_id", F.lit(NO_ID)))

    anchors = docs.select("key", "text").mapInArrow(_anchor_rows(window), "anchor long, key long, times int")
    seen_again = anchors.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor")
    anchored = (
        anchors.select("anchor", "key").join(seen_again, "anchor", "left_semi")
        .groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    )

    digests = docs.filter("text is not null").select("key", F.unhex(F.md5("text")).alias("digest"), F.xxhash64("text").alias("hash"))
    sets = digests.groupBy("digest").agg(F.count("*").alias("n"), F.min("key").alias("least")).filter("n > 1")
    # Written, so that both sides of the join are plain shuffles and AQE can split a digest that many rows have.
    sets = saved(sets.drop("n"), "copies")
    copies = (
        digests.join(sets, "digest").groupBy("key")
        .agg(F.collect_set("hash").alias("copies"), F.collect_set(F.when(F.col("key") == F.col("least"), F.col("hash"))).alias("firsts"))
    )

    known = anchored.join(copies, "key", "full")
    hashed = docs.select("doc_id", "key", F.xxhash64("text").alias("hash"), "text")
    packed = hashed.mapInArrow(_packed, "doc_id long, key long, hash long, packed binary")
    work = packed.join(known, "key", "left").select(
        "doc_id", "key", "packed", "anchors",
        *(F.coalesce(F.array_contains(c, F.col("hash")), F.lit(False)).alias(n) for c, n in (("copies", "copied"), ("firsts", "first"))),
    )
    windows = work.mapInArrow(_window_rows(window), "h1 long, h2 int, times int, key long")
    repeated = windows.groupBy("h1", "h2").agg(F.sum("times").alias("n")).filter("n > 1").select("h1", "h2")
    again = (
        windows.filter("key is not null").select("h1", "h2", "key").join(repeated, ["h1", "h2"], "left_semi")
        .groupBy("key").agg(F.collect_set("h1").alias("again"))
    )
    return work.join(again, "key", "left").mapInArrow(
        _kept_rows(window), "doc_id long, n_words long, n_removed long, kept_text string"
    )
