"""Benchmark passages in documents, by a prefix-filtered set join.

A window is a run of consecutive words of a benchmark item; its set is its shingles. Documents' shingles are counted
first, for those that the benchmark has, and every window orders its shingles by that rarity. Containment is whole, so
the necessary prefix of a window is its single rarest shingle: a document without it cannot hold the window. Where a
document has a prefix shingle, the window's place follows from the shingle's offset; the length and the position bound
the candidates, and the words are then compared over the window.

The benchmark's side is sent to the tasks in blocks of a fixed number of windows, so what a task holds is bounded
however large the benchmark is; documents are read once per block and never shuffled. What comes back is one row per
document and block.

Defined results: a null or empty text has no words and holds nothing; an item without words has no window; equal items
each count; repeated document rows are judged one by one; a null item id never counts as an item, though its windows
do; columns other than the ids and the texts are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved
from shelfwatch.llm.words import NOT_ALNUM, Words, combine, count_words, mix, runs, signed, text_blocks, words_of
from shelfwatch.llm.workers import tidy

SHINGLE = 4
WINDOWS_PER_BLOCK = 500_000


def _words(texts: list[bytes], seed: int = 1) -> Words:
    return words_of(texts, NOT_ALNUM, lower=True, seed=seed)


def _width(k: int) -> int:
    return min(k, SHINGLE)


def _item_windows(window: int):
    """Per window of each item: its two hashes, its length, and the shingles it holds by offset."""

    @tidy
    def rows(batches):
        for batch in batches:
            ids = batch.column("item_id")
            for begin, texts in text_blocks(batch):
                for i, text in enumerate(texts):
                    words = _words([text])
                    k = min(window, len(words.hash))
                    if not k:
                        continue
                    one, two = runs(words.hash, k), runs(_words([text], seed=2).hash, k)
                    shingle = runs(words.hash, _width(k))
                    per = k - _width(k) + 1
                    held = np.lib.stride_tricks.sliding_window_view(shingle, per)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "item_id": pa.array([ids[begin + i].as_py()] * len(one), pa.string()),
                            "h1": signed(one),
                            "h2": signed(two),
                            "length": np.full(len(one), k, np.int32),
                            "shingles": pa.array([signed(s) for s in held], pa.list_(pa.int64())),
                        }
                    )

    return rows


def _shingles_found(wanted, widths):
    """Counts of the wanted shingles (sorted) in each batch of documents, per shingle width."""

    @tidy
    def rows(batches):
        known = wanted.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, texts in text_blocks(batch):
                words = _words(texts)
                for width in widths:
                    value = runs(words.hash, width)
                    value = value[words.left()[: len(value)] >= width]
                    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                    total += np.bincount(at[known[at] == value], minlength=len(known))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"shingle": signed(known[hit]), "n": total[hit]})

    return rows


def _find(index):
    """Per document with a window of the block: its hit words as [from, to) pairs, and the windows found."""

    @tidy
    def rows(batches):
        block = index.value
        for batch in batches:
            keys = batch.column("row_key")
            for begin, texts in text_blocks(batch):
                words = _words(texts)
                left = words.left()
                spans, window = _matches(words, left, block, lambda texts=texts: _words(texts, seed=2).hash)
                if not len(spans):
                    continue
                text = np.searchsorted(words.first, spans[:, 0], "right") - 1
                order = np.lexsort((spans[:, 0], text))
                spans, text, window = spans[order], text[order], window[order]
                cut = np.flatnonzero(np.diff(text, prepend=-1))
                base = words.first[text]
                place = (spans - base[:, None]).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row_key": keys.take(pa.array(begin + text[cut])),
                        "starts": pa.array(np.split(place[:, 0], cut[1:]), pa.list_(pa.int32())),
                        "ends": pa.array(np.split(place[:, 1], cut[1:]), pa.list_(pa.int32())),
                        "windows": pa.array([np.unique(w) for w in np.split(window, cut[1:])], pa.list_(pa.int64())),
                    }
                )

    return rows


def _matches(words: Words, left: np.ndarray, block: dict, second) -> tuple[np.ndarray, np.ndarray]:
    """Spans of words, and the windows found there (by number); `second` gives the words' other hashes."""
    spans, found = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
    other = None
    for length, part in block.items():
        value = runs(words.hash, _width(length))
        prefix = part["prefix"]  # sorted; a shingle may be the prefix of several windows
        low = np.searchsorted(prefix, value, "left")
        hit = np.flatnonzero((low < len(prefix)) & (prefix[np.minimum(low, len(prefix) - 1)] == value))
        if not len(hit):
            continue
        low, high = low[hit], np.searchsorted(prefix, value[hit], "right")
        which = np.repeat(low, high - low) + (np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low))
        place = np.repeat(hit, high - low) - part["offset"][which]
        # The window must begin in the text that has the shingle, and the text must be long enough from there.
        text = np.searchsorted(words.first, np.repeat(hit, high - low), "right") - 1
        bounded = place >= words.first[text]
        place, which = place[bounded], which[bounded]
        long_enough = left[place] >= length
        place, which = place[long_enough], which[long_enough]
        if not len(place):
            continue
        if other is None:
            other = second()
        same = (_window_hash(words.hash, place, length) == part["h1"][which]) & (
            _window_hash(other, place, length) == part["h2"][which]
        )
        place, which = place[same], which[same]
        spans.append(np.stack([place, place + length], axis=1))
        found.append(part["window"][which])
    return np.concatenate(spans), np.concatenate(found)


def _window_hash(hashes: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """runs(hashes, k) at some places only."""
    picked = hashes[place[:, None] + np.arange(k)]
    power, width, done, covered = picked, 1, None, 0
    while True:
        if k & width:
            done = power[:, covered] if done is None else combine(done, power[:, covered])
            covered += width
        if covered == k:
            return mix(done + np.uint64(k))
        power = combine(power[:, : power.shape[1] - width], power[:, width:])
        width *= 2


@tidy
def _count(batches):
    for batch in batches:
        n = [count_words(t, NOT_ALNUM, lower=True) for _, texts in text_blocks(batch) for t in texts]
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "row_key": batch.column("row_key"), "n_words": pa.array(n, pa.int64())}
        )


@tidy
def _merge(batches):
    """The hit words of each document as spans that don't touch."""
    for batch in batches:
        spans = []
        for starts, ends in zip(batch.column("starts"), batch.column("ends")):
            start = np.sort(np.concatenate([s.values.to_numpy() for s in starts.values]))
            end = np.sort(np.concatenate([e.values.to_numpy() for e in ends.values]))
            cut = np.flatnonzero(start[1:] > end[:-1])  # all open spans have ended before the next begins
            spans.append(np.stack([start[np.append(0, cut + 1)], end[np.append(cut, len(end) - 1)]], axis=1).tolist())
        yield pa.RecordBatch.from_pydict(
            {
                "row_key": batch.column("row_key"),
                "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                "windows": batch.column("windows"),
            }
        )


def _blocks(spark, prefixes: DataFrame, n_blocks: int):
    """The windows in blocks of bounded size, each as {length: arrays sorted by prefix}."""
    for b in range(n_blocks):
        rows = prefixes.filter(F.pmod("window", F.lit(n_blocks)) == b).toPandas()
        block = {}
        for length, part in rows.groupby("length"):
            prefix = part["prefix"].to_numpy().view(np.uint64)
            order = np.argsort(prefix)
            block[int(length)] = {
                "prefix": prefix[order],
                "offset": part["offset"].to_numpy()[order],
                "h1": part["h1"].to_numpy().view(np.uint64)[order],
                "h2": part["h2"].to_numpy().view(np.uint64)[order],
                "window": part["window"].to_numpy()[order],
            }
        yield spark.sparkContext.broadcast(block)


def find_windows(docs: DataFrame, items: DataFrame, window: int, per_block: int) -> tuple[DataFrame, DataFrame]:
    """The benchmark's windows (item_id, window), and (row_key, starts, ends, windows) per document and block."""
    spark = docs.sparkSession
    windows = saved(
        items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
            _item_windows(window), "item_id string, h1 long, h2 long, length int, shingles array<long>"
        ),
        "windows",
    )
    distinct = windows.groupBy("h1", "h2", "length").agg(F.first("shingles").alias("shingles"))
    n_blocks = max(1, -(-distinct.count() // per_block))

    # How often documents have each shingle of the benchmark, counted over all of them, in as many blocks.
    shingles = distinct.select(F.explode("shingles").alias("shingle"), F.least("length", F.lit(SHINGLE)).alias("width")).distinct()
    counts = None
    for b in range(n_blocks):
        part = shingles.filter(F.pmod("shingle", F.lit(n_blocks)) == b).toPandas()
        wanted = spark.sparkContext.broadcast(np.unique(part["shingle"].to_numpy().view(np.uint64)))
        widths = sorted(int(w) for w in part["width"].unique())
        if len(part):
            found = docs.select("text").mapInArrow(_shingles_found(wanted, widths), "shingle long, n long")
            counts = found if counts is None else counts.union(found)
    rarity = spark.createDataFrame([], "shingle long, n long") if counts is None else counts
    rarity = rarity.groupBy("shingle").agg(F.sum("n").alias("n"))

    # The prefix of a window is its rarest shingle; one that no document has shows that the window occurs nowhere.
    held = distinct.select("h1", "h2", "length", F.posexplode("shingles").alias("offset", "prefix"))
    ranked = held.join(rarity.withColumnRenamed("shingle", "prefix"), "prefix", "left")
    prefixes = (
        ranked.groupBy("h1", "h2", "length")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "prefix")).alias("rarest"))
        .filter("rarest.n > 0")
        .select("h1", "h2", "length", "rarest.offset", "rarest.prefix", F.xxhash64("h1", "h2", "length").alias("window"))
    )
    prefixes = saved(prefixes, "prefixes")
    occurrences = None
    for block in _blocks(spark, prefixes, n_blocks):
        part = docs.select("row_key", "text").mapInArrow(
            _find(block), "row_key long, starts array<int>, ends array<int>, windows array<long>"
        )
        occurrences = part if occurrences is None else occurrences.union(part)
    numbered = windows.select("item_id", F.xxhash64("h1", "h2", "length").alias("window")).distinct()
    return numbered, occurrences


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 13, one_in: int = 20, per_block: int = WINDOWS_PER_BLOCK
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans (hit words as [from, to)), items (sorted item ids), contaminated.

    A word is hit inside any occurrence of a window of `window` words of an item (of the whole item, if that is
    shorter). A document is contaminated if one word in `one_in` or more is hit. Words are runs of digits, letters
    and other characters beyond ASCII, with A to Z in lower case.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    numbered, occurrences = find_windows(docs, items, window, per_block)
    # Rows that are repeated find the same; one of them is enough.
    found = saved(
        occurrences.dropDuplicates(["row_key", "starts", "ends"]).groupBy("row_key").agg(
            F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"),
            F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"),
        ),
        "found",
    )
    found = found.mapInArrow(_merge, "row_key long, spans array<array<long>>, windows array<long>")
    item_ids = (
        found.select("row_key", F.explode("windows").alias("window")).join(numbered, "window")
        .groupBy("row_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    hits = found.drop("windows").join(item_ids, "row_key", "left")
    counted = docs.mapInArrow(_count, "doc_id long, row_key long, n_words long")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0]), F.lit(0).cast("long"))
    return counted.join(hits, "row_key", "left").withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit",
        F.coalesce("spans", F.array().cast("array<array<long>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
