"""Exact Jaccard self-join of documents' word n-grams, by partitioning the universe of shingles.

Sets of similar size form bands. Per band, shingles are hashed into more segments than two linked sets can have
differences, so by the pigeonhole principle they agree on some segments entirely; what a set holds of a segment is one
index key. A set needs one unit more than the differences it must bear. The allocation is by cost: segments with a
rare shingle come first; where they are too few, a segment may be searched with one difference (keys of all subsets
with one shingle left out, which some segments of each band are indexed by), which is worth two units; segments of
common shingles only come last, empty ones never. Common shingles are counted over all documents, batch by batch.
How many segments a band has is raised until every set finds its units, so no set is left out.

Each key's members are read in order as a stream. Pairs are not spelled out within a group: the first round verifies
each set against the one member it shares most keys with, linked sets are contracted, and only pairs of different
components are looked at again, in the end all that a key still puts together: first for some of the keys, then,
contracted again, for the rest. A set that searches more segments than it may differ in must share the surplus of keys
with whatever it links with, so sets that meet others in fewer keys are passed over then. Sets that are equal were one
from the start.

A parity sketch bounds the differences of two sets from below (each differing shingle flips one bit), so most pairs
that cannot link are dropped before their sets are fetched. Verification is exact on whole sets of 64-bit hashes.

Defined results: a null or empty text, or one without words, has no shingles and links with nothing; one with fewer
words than the n-gram has a single shingle; rows that repeat an id are one document, as are all null ids (returned
with a null component if alone); columns other than the id and the text are ignored.
"""

from __future__ import annotations

import contextlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwatch.llm.components import components
from shelfwatch.llm.tables import saved, small
from shelfwatch.llm.words import SPACE, combine, mix, runs, signed, text_blocks, words_of
from shelfwatch.llm.workers import tidy

NO_ID = -(2**63)
BAND_RATIO = 1.6
SPARE = 0.06
LEAST_SEGMENTS = 64
DELETABLE = 0.06
# A shingle is common if so large a part of a batch's documents has it, and of all; at most so many are told apart.
COMMON = 0.005
COMMON_KEPT = 100_000
# Sketches have a 64-bit word for so many shingles, at most so many words; always a power of two. Folded to the least
# number of words they are columns of their own, which pairs are compared by first.
SHINGLES_PER_WORD = 32
SKETCH_WORDS = 1024
NARROW_WORDS = 8
# So many of the keys with the most pairs give a pair once among them; others give none that these have given.
LARGE_KEYS = 256
# The keys of the first of the last rounds: one in so many.
FIRST_KEYS = 16
# Pairs whose sets are compared at a time: together a bounded number of times the longest text.
PAIRS_AT_ONCE = 200
EDGES = [1, 2, 3, 4]
while EDGES[-1] < 2**40:
    EDGES.append(int(EDGES[-1] * BAND_RATIO))
EDGES = np.array(EDGES)


class Sets:
    """Distinct shingles of some documents: hashes grouped by document, and where each document's begin."""

    def __init__(self, texts: list[bytes], ngram: int):
        words = words_of(texts, SPACE, lower=True)
        value = runs(words.hash, ngram)
        text, left = words.text_of(), words.left()
        place = np.flatnonzero(left[: len(value)] >= ngram)
        short = np.flatnonzero((words.counts > 0) & (words.counts < ngram))
        whole = []
        for i in short:
            whole.append(runs(words.hash[words.first[i] : words.first[i + 1]], int(words.counts[i]))[0])
        doc = np.concatenate([text[place], short]).astype(np.uint16 if len(texts) < 65536 else np.int64)
        value = np.concatenate([value[place], np.array(whole, np.uint64)])
        order = np.argsort(value)
        order = order[np.argsort(doc[order], kind="stable")]
        doc, value = doc[order], value[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        self.doc, self.value = doc[new].astype(np.int64), value[new]
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.size = np.diff(self.first)
        self.mixed = mix(self.value)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each whole set."""
        out = []
        for salt in (0x51ED270B, 0x2545F491):
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.value ^ np.uint64(salt)), dtype=np.uint64)])
            out.append(mix(total[self.first[1:]] - total[self.first[:-1]] + self.size.astype(np.uint64)))
        return out[0], out[1]


    def sketches(self) -> pa.ListArray:
        """Per document the parity of how many of its shingles fall on each bit."""
        words = np.ceil(np.log2(np.clip(self.size / SHINGLES_PER_WORD, NARROW_WORDS, SKETCH_WORDS))).astype(np.int64)
        words = np.left_shift(1, words)
        base = np.concatenate([[0], np.cumsum(64 * words)])
        bit = (mix(self.mixed ^ np.uint64(0x0DD)) & (64 * words[self.doc] - 1).astype(np.uint64)).astype(np.int64)
        parity = np.bincount(base[self.doc] + bit, minlength=base[-1]) & 1
        packed = np.packbits(parity.astype(np.uint8), bitorder="little").view("<i8")
        return pa.ListArray.from_arrays((base // 64).astype(np.int32), packed)


def narrow(sketch: Column) -> list[Column]:
    """The sketch folded to the least number of words."""
    parts = F.transform(F.sequence(F.lit(0), (F.size(sketch) / NARROW_WORDS).cast("int") - 1), lambda i: F.slice(sketch, i * NARROW_WORDS + 1, NARROW_WORDS))
    folded = F.aggregate(parts, F.array_repeat(F.lit(0).cast("long"), NARROW_WORDS), lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)))
    return [folded[i].alias(f"narrow_{i}") for i in range(NARROW_WORDS)]


def few_apart(apart: Column, size_x: Column, size_y: Column, percent: int) -> Column:
    """Whether sets of these sizes may link with so many differences."""
    return (100 + percent) * apart <= (100 - percent) * (size_x + size_y)


def may_link(x: Column, y: Column, size_x: Column, size_y: Column, percent: int) -> Column:
    """Whether the sketches allow so few differences that the sets may link. Exact in what it rules out."""

    def folded(s, other):
        half = (F.size(s) / 2).cast("int")
        fold = F.zip_with(F.slice(s, 1, half), F.slice(s, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(s) > F.size(other), fold).otherwise(s)

    apart = F.aggregate(
        F.zip_with(folded(x, y), folded(y, x), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, k: n + k
    )
    return few_apart(apart, size_x, size_y, percent)


def band_of(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, size, "right") - 1


def segments_of(band: np.ndarray, attempt: np.ndarray, percent: int) -> np.ndarray:
    """How many segments the shingles of a band go into: more than any pair with its smaller set there may differ."""
    top = EDGES[band + 1] - 1
    largest = top * 100 // percent
    differ = (100 - percent) * (top + largest) // (100 + percent)
    count = np.maximum(np.ceil((differ + 1) * (1 + SPARE)).astype(np.int64) + 8, LEAST_SEGMENTS)
    return count << attempt


class Segments:
    """What each document's set holds of each segment, as seen from one band."""

    def __init__(self, sets: Sets, docs: np.ndarray, band: np.ndarray, attempt: np.ndarray, percent: int, common: np.ndarray):
        """docs: some documents (rising); band, attempt: of the index they are placed in. common: per shingle."""
        self.docs, self.band = docs, band
        self.count = segments_of(band, attempt, percent)
        self.base = np.concatenate([[0], np.cumsum(self.count)])
        size = sets.size[docs]
        which = np.repeat(np.arange(len(docs)), size)
        self.token = np.repeat(sets.first[docs] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        place = (mix(sets.mixed[self.token] ^ np.uint64(0xA5A5)) % self.count[which].astype(np.uint64)).astype(np.int64)
        self.group = self.base[which] + place
        total = int(self.base[-1])
        self.held = np.bincount(self.group, minlength=total)
        self.rare = np.bincount(self.group[~common[self.token]], minlength=total)
        self.sum = np.zeros(total, np.uint64)
        np.add.at(self.sum, self.group, sets.mixed[self.token])
        self.doc = np.repeat(np.arange(len(docs)), self.count)
        self.number = np.arange(total) - np.repeat(self.base[:-1], self.count)
        self.deletable = self.number < np.ceil(self.count[self.doc] * DELETABLE) + 2

    def key(self, total: np.ndarray, held: np.ndarray, group: np.ndarray, space: int) -> np.ndarray:
        doc = self.doc[group]
        where = combine(self.number[group].astype(np.uint64), (self.band[doc] * 4 + space).astype(np.uint64))
        return combine(mix(total) + held.astype(np.uint64), where ^ self.count[doc].astype(np.uint64))

    def _first(self, allowed: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Marks each document's first `wanted` allowed segments."""
        run = np.cumsum(allowed)
        before = np.concatenate([[0], run])[self.base[:-1]]
        return allowed & (run - before[self.doc] <= wanted[self.doc])

    def _count(self, marks: np.ndarray) -> np.ndarray:
        return np.add.reduceat(marks.astype(np.int64), self.base[:-1])

    def filled(self) -> np.ndarray:
        """How many segments each document has something in."""
        return self._count(self.held > 0)

    def allocate(self, differ: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments to search as they are, and those to search with one difference: more units than `differ`.

        Also of how many of the former a document has at least one in common with whatever it links with.

        As every filled segment gives a unit, there are enough wherever more than `differ` are filled.
        """
        need = differ + 1
        exact = self.rare > 0
        missing = need - self._count(exact)
        near = self._first(self.deletable & (self.rare > 1), np.maximum(missing, 0))
        missing = missing - self._count(near)
        late = self._first((self.held > 0) & ~exact, np.maximum(missing, 0))
        exact |= late
        return exact, near, np.maximum(self._count(exact) - differ, 1)


def differences(size: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles two linked sets of these sizes may not share, at most."""
    return (100 - percent) * (size + other) // (100 + percent)


def _bands_searched(size: np.ndarray, percent: int):
    """Per step down: the documents that search that band, the band, and the largest set there they must find."""
    own = band_of(np.maximum(size, 1))
    least = -(-size * percent // 100)
    step = 0
    while True:
        band = own - step
        docs = np.flatnonzero((size > 0) & (band >= 0) & (EDGES[np.maximum(band, 0) + 1] > least))
        if step and not len(docs):
            return
        yield step, docs, band[docs], np.minimum(size[docs], EDGES[band[docs] + 1] - 1)
        step += 1


def _statistics(ngram: int, percent: int):
    """Per document its set's size, digests, and how often its bands' segments must be doubled; common shingles."""

    @tidy
    def rows(batches):
        for batch in batches:
            for begin, texts in text_blocks(batch):
                sets = Sets(texts, ngram)
                d1, d2 = sets.digests()
                yield _rows(0, batch.column("doc_id").slice(begin, len(texts)), sets.size, signed(d1), signed(d2), sets.sketches())
                for _, docs, band, other in _bands_searched(sets.size, percent):
                    attempt = 0
                    while len(docs):
                        seen = Segments(sets, docs, band, np.full(len(docs), attempt), percent, np.zeros(len(sets.value), bool))
                        lacking = seen.filled() <= differences(sets.size[docs], other, percent)
                        docs, band, other = docs[lacking], band[lacking], other[lacking]
                        attempt += 1
                        yield _rows(1, band, np.full(len(docs), attempt))
                value, total = np.unique(sets.value, return_counts=True)
                often = total >= max(8, COMMON * len(texts))
                yield _rows(2, signed(value[often]), total[often])

    return rows


STATS = "kind int, doc_id long, size long, d1 long, d2 long, sketch array<long>"


def _rows(kind, doc_id, size, *more):
    n = len(size)
    d1, d2, sketch = more or (np.zeros(n, np.int64), np.zeros(n, np.int64), pa.nulls(n, pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind, np.int32)), pa.array(doc_id, pa.int64()), pa.array(size, pa.int64()),
            pa.array(d1), pa.array(d2), sketch,
        ],
        ["kind", "doc_id", "size", "d1", "d2", "sketch"],
    )


def _keys(ngram: int, percent: int, plan):
    """(key, doc_id, searching): what each set is indexed by, and what it searches for. Equal sets of a task: once.

    searching: in how many such keys it meets at least whatever it links with; 0 for what is only indexed.
    """

    @tidy
    def rows(batches):
        common_sorted, attempts = plan.value
        done: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for begin, texts in text_blocks(batch):
                sets = Sets(texts, ngram)
                fresh = np.zeros(len(texts), bool)
                for i, digest in enumerate(zip(*(d.tolist() for d in sets.digests()))):
                    if sets.size[i] and digest not in done:
                        done.add(digest)
                        fresh[i] = True
                common = np.zeros(len(sets.value), bool)
                if len(common_sorted):
                    at = np.minimum(np.searchsorted(common_sorted, sets.value), len(common_sorted) - 1)
                    common = common_sorted[at] == sets.value
                for step, docs, band, other in _bands_searched(np.where(fresh, sets.size, 0), percent):
                    if not len(docs):
                        continue
                    seen = Segments(sets, docs, band, attempts[band], percent, common)
                    exact, near, shared = seen.allocate(differences(sets.size[docs], other, percent))
                    yield from _key_rows(seen, sets, ids[begin + docs], exact, near, shared, index=step == 0)

    return rows


def _key_rows(seen: Segments, sets: Sets, ids, exact, near, shared, index: bool):
    def batch(group, total, held, space, searching):
        searching = np.where(searching, shared[seen.doc[group]], 0).astype(np.int32)
        return pa.RecordBatch.from_pydict(
            {
                "key": signed(seen.key(total, held, group, space)),
                "doc_id": ids[seen.doc[group]],
                "searching": searching,
            }
        )

    group = np.flatnonzero(seen.held > 0 if index else exact)
    yield batch(group, seen.sum[group], seen.held[group], 0, exact[group])
    # One shingle less, in the indexed set (space 1) or in the searching one (space 0).
    for space, marks in ((1, seen.deletable & (seen.held > 1)),) * index + ((0, near),):
        at = np.flatnonzero(marks[seen.group])
        group = seen.group[at]
        yield batch(group, seen.sum[group] - sets.mixed[seen.token[at]], seen.held[group] - 1, space, space == 0)
    group = np.flatnonzero(near)
    yield batch(group, seen.sum[group], seen.held[group], 1, True)


@tidy
def _members(batches):
    """Of rows in order of key, searching members first: those of groups with two members or more, and the first one.

    A group is never held: what a batch leaves open is its last row, whether that was given out, and its group's first
    member.
    """
    held = None  # the last row: key, doc_id, searching; whether it was given out; its group's first member, and its use
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, searching = (batch.column(c).to_numpy() for c in ("key", "doc_id", "searching"))
        if held is not None:
            key, doc, searching = np.append(held[0], key), np.append(held[1], doc), np.append(held[2], searching)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        begins = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        first, usable = doc[begins][group], searching[begins][group] > 0
        if held is not None:
            same = group == 0
            first, usable = np.where(same, held[4], first), np.where(same, held[5], usable)
        grouped = np.zeros(len(key), bool)
        grouped[1:] |= ~new[1:]
        grouped[:-1] |= ~new[1:]
        if held is not None and held[3]:
            grouped[0] = False
        out = grouped & usable
        yield pa.RecordBatch.from_pydict({"key": key[out], "doc_id": doc[out], "searching": searching[out], "first": first[out]})
        given = bool(len(key) > 1 and not new[-1])
        held = (key[-1], doc[-1], searching[-1], given, first[-1], usable[-1])


def _verify(percent: int):
    @tidy
    def rows(batches):
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                shared = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * shared >= percent * (len(a) + len(b) - shared))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return rows


def _set_rows(ngram: int):
    @tidy
    def rows(batches):
        for batch in batches:
            for begin, texts in text_blocks(batch):
                sets = Sets(texts, ngram)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, len(texts)), pa.ListArray.from_arrays(sets.first.astype(np.int32), signed(sets.value))],
                    ["doc_id", "shingles"],
                )

    return rows


@contextlib.contextmanager
def rows_at_a_time(spark: SparkSession, rows: int):
    """Lets Python tasks that are started meanwhile get no more rows at a time; two sets of very long texts are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Join:
    """The rounds of verification over one table of documents."""

    def __init__(self, docs: DataFrame, ngram: int, percent: int):
        self.docs, self.ngram, self.percent = docs, ngram, percent
        spark = docs.sparkSession
        stats = saved(docs.mapInArrow(_statistics(ngram, percent), STATS), "statistics")
        sizes = stats.filter("kind = 0").select("doc_id", "size", "d1", "d2")
        same = saved(sizes.filter("size > 0").groupBy("size", "d1", "d2").agg(F.min("doc_id").alias("set_id")), "distinct")
        named = sizes.join(same, ["size", "d1", "d2"], "left")
        self.sizes = saved(named.select("doc_id", "size", F.coalesce("set_id", "doc_id").alias("set_id")), "sizes")
        sketched = stats.filter("kind = 0 AND size > 0").join(same.withColumnRenamed("set_id", "doc_id"), ["doc_id", "size", "d1", "d2"], "left_semi")
        sketched = sketched.select(F.col("doc_id").alias("set_id"), "size", "sketch").distinct()
        self.sketches = saved(sketched.select("*", *narrow(F.col("sketch"))), "sketches")
        self.plan = spark.sparkContext.broadcast((self._common(stats), self._attempts(stats)))

    def _common(self, stats: DataFrame) -> np.ndarray:
        """The commonest shingles, a bounded number; they steer the allocation and never the result."""
        found = stats.filter("kind = 2").groupBy("doc_id").agg(F.sum("size").alias("n"))
        least = COMMON * max(1, self.sizes.count())
        found = found.filter(F.col("n") >= least).orderBy(F.desc("n"), "doc_id").limit(COMMON_KEPT)
        return np.sort(np.array([r.doc_id for r in found.select("doc_id").collect()], np.int64).view(np.uint64))

    def _attempts(self, stats: DataFrame) -> np.ndarray:
        out = np.zeros(len(EDGES), np.int64)
        for r in stats.filter("kind = 1").groupBy("doc_id").agg(F.max("size").alias("n")).collect():  # a row per band
            out[r.doc_id] = r.n
        return out

    def members(self) -> DataFrame:
        keys = self.docs.mapInArrow(_keys(self.ngram, self.percent, self.plan), "key long, doc_id long, searching int")
        ordered = keys.repartition("key").sortWithinPartitions("key", F.desc("searching"), "doc_id")
        return saved(ordered.mapInArrow(_members, "key long, doc_id long, searching int, first long"), "members")

    def as_sets(self, pairs: DataFrame) -> DataFrame:
        """Pairs of documents as pairs of different sets that may link, with how often they were found."""
        one = small(self.sizes.select(F.col("doc_id").alias("x"), F.col("set_id").alias("a")))
        two = small(self.sizes.select(F.col("doc_id").alias("y"), F.col("set_id").alias("b")))
        sets = (
            pairs.join(one, "x").join(two, "y").filter(F.col("a") != F.col("b"))
            .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("n"))
        )
        return self.fitting(sets).select("a", "b", "n").dropDuplicates(["a", "b"])

    def fitting(self, pairs: DataFrame) -> DataFrame:
        """The pairs of sets whose whole sketches allow a link."""
        one = self.sketches.select(F.col("set_id").alias("a"), *self.seen("a"), F.col("sketch").alias("sketch_a"))
        two = self.sketches.select(F.col("set_id").alias("b"), *self.seen("b"), F.col("sketch").alias("sketch_b"))
        whole = may_link(F.col("sketch_a"), F.col("sketch_b"), F.col("size_a"), F.col("size_b"), self.percent)
        return pairs.join(one, "a").join(two, "b").filter(F.when(self.fits(), whole).otherwise(False))

    def seen(self, side: str) -> list[Column]:
        """Of the sketches, the columns that the first comparison needs, named by side."""
        return [F.col(c).alias(f"{c}_{side}") for c in ("size", *(f"narrow_{i}" for i in range(NARROW_WORDS)))]

    def fits(self) -> Column:
        """Whether sizes and folded sketches allow a link; of built-in parts that are compiled, for very many pairs."""
        size_a, size_b = F.col("size_a"), F.col("size_b")
        sizes = 100 * F.least(size_a, size_b) >= self.percent * F.greatest(size_a, size_b)
        apart = sum((F.bit_count(F.col(f"narrow_{i}_a").bitwiseXOR(F.col(f"narrow_{i}_b"))) for i in range(NARROW_WORDS)), F.lit(0))
        return sizes & few_apart(apart, size_a, size_b, self.percent)

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        wanted = saved(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
        found = self.docs.join(small(wanted), "doc_id", "left_semi").mapInArrow(_set_rows(self.ngram), "doc_id long, shingles array<long>")
        return saved(found, "sets")

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
        b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
        both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
        with rows_at_a_time(pairs.sparkSession, PAIRS_AT_ONCE):
            return saved(both.mapInArrow(_verify(self.percent), "a long, b long").distinct(), "verified")

    def components(self) -> DataFrame:
        members = self.members()
        star = members.filter("doc_id != first").groupBy(F.col("first").alias("x"), F.col("doc_id").alias("y")).agg(F.count("*").alias("n"))
        star = saved(self.as_sets(star), "pairs")
        sets = self.sets_of(star)
        ends = star.select("a", "b", "n", F.explode(F.array("a", "b")).alias("end"))
        best = ends.groupBy("end").agg(F.max(F.struct("n", "a", "b")).alias("best")).select("best.a", "best.b").distinct()
        best = saved(best, "round")
        links = self.links(best, sets)
        groups = components(links)

        rest = saved(self.apart(star.join(best, ["a", "b"], "left_anti"), groups), "round")
        links = links.union(self.links(rest, sets))
        groups = components(links)

        done = best.union(rest)
        members = self.named(members)
        for part in (FIRST_KEYS, 1):
            members = self.mixed(members, groups)
            left = saved(self.within_keys(members, part).join(done, ["a", "b"], "left_anti"), "round")
            if left.take(1):
                links = links.union(self.links(left, self.sets_of(left)))
                done = done.union(left)
                groups = components(links)
        return groups

    def apart(self, pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """The pairs that are not in one component already."""
        one = groups.select(F.col("node").alias("a"), F.col("component").alias("group_a"))
        two = groups.select(F.col("node").alias("b"), F.col("component").alias("group_b"))
        same = F.coalesce("group_a", "a") == F.coalesce("group_b", "b")
        return pairs.join(one, "a", "left").join(two, "b", "left").filter(~same).select("a", "b")

    def named(self, members: DataFrame) -> DataFrame:
        """Members of keys by set."""
        return members.join(small(self.sizes.select("doc_id", "set_id")), "doc_id").select("key", "set_id", "searching")

    def mixed(self, named: DataFrame, groups: DataFrame) -> DataFrame:
        """The members of keys that hold different components, with these."""
        found = small(groups.select(F.col("node").alias("set_id"), F.col("component").alias("found")))
        named = named.select("key", "set_id", "searching").join(found, "set_id", "left")
        named = named.select("key", "set_id", "searching", F.coalesce("found", "set_id").alias("component"))
        # One shuffle: what a key holds is compared beside its rows. Copies of a set in different tasks are one.
        whole = Window.partitionBy("key")
        named = named.withColumns({"low": F.min("component").over(whole), "high": F.max("component").over(whole)})
        return saved(named.filter("low != high").drop("low", "high").distinct(), "apart")

    def large_keys(self, searching: DataFrame, others: DataFrame) -> DataFrame:
        """The keys with the most pairs, numbered from the largest on: key, place."""
        pairs = searching.groupBy("key").agg(F.countDistinct("set_id").alias("n")).join(others.groupBy("key").agg(F.countDistinct("set_id").alias("of")), "key")
        top = pairs.filter("n * of > 1").select("key", (F.col("n") * F.col("of")).alias("pairs")).orderBy(F.desc("pairs"), "key").limit(LARGE_KEYS)
        return saved(top.select("key", (F.row_number().over(Window.orderBy(F.desc("pairs"), "key")) - 1).alias("place")), "large")

    def shifted(self, bits: int, by: Column) -> Column:
        return F.call_function("shiftleft", F.lit(bits).cast("long"), by.cast("int"))

    def places(self, rows: DataFrame, large: DataFrame, side: str) -> DataFrame:
        """Per set that is in such keys, which ones, as bits."""
        bit = lambda i: F.when(F.floor(F.col("place") / 64) == i, self.shifted(1, F.pmod("place", F.lit(64))))
        marks = [F.bit_or(F.coalesce(bit(i), F.lit(0).cast("long"))).alias(f"large_{i}_{side}") for i in range(LARGE_KEYS // 64)]
        return rows.join(F.broadcast(large), "key").groupBy("set_id").agg(*marks)

    def below(self, place: Column, word: int) -> Column:
        """The bits of a word that stand for keys before this place."""
        all_of, none = F.lit(-1).cast("long"), F.lit(0).cast("long")
        some = F.bitwise_not(self.shifted(-1, place - 64 * word))
        return F.when(place >= 64 * (word + 1), all_of).when(place <= 64 * word, none).otherwise(some)

    def within_keys(self, mixed: DataFrame, part: int) -> DataFrame:
        """Pairs of different components that one in `part` keys puts together and that may link."""
        searching = mixed.filter("searching > 0")
        # Whoever meets others in fewer keys than it shares with any set it links with, links with none of them.
        able = searching.groupBy("set_id", "searching").agg(F.count("*").alias("n")).filter("n >= searching")
        searching = searching.join(saved(able.drop("n"), "able"), ["set_id", "searching"], "left_semi")
        # Near copies have hundreds of keys in common. Of keys with the same members, of whom the same are searching,
        # one is enough; they are told by hashes over the members and over those.
        marked = lambda rows, name: rows.groupBy("key").agg(
            *(F.bit_xor(F.xxhash64("set_id", "searching", F.lit(salt))).alias(f"{name}_{salt}") for salt in (1, 2)), F.count("*").alias(name)
        )
        alike = marked(searching, "able").join(marked(mixed.select("key", "set_id", "searching"), "all"), "key")
        one = alike.groupBy("able_1", "able_2", "able", "all_1", "all_2", "all").agg(F.min("key").alias("key")).select("key")
        searching = searching.join(saved(one, "keys"), "key", "left_semi")
        searching = saved(searching.filter(F.pmod(F.xxhash64("key"), F.lit(part)) == 0), "searching")
        others = mixed.join(searching.select("key").distinct(), "key", "left_semi")
        # Near copies meet in many keys: whole sketches are compared once a pair.
        found = self.meetings(searching, others)
        found = found.select(F.least("set_id_a", "set_id_b").alias("a"), F.greatest("set_id_a", "set_id_b").alias("b")).distinct()
        return self.fitting(found).select("a", "b")

    def meetings(self, searching: DataFrame, others: DataFrame) -> DataFrame:
        """Sets of different components that meet in a key and that may link by their folded sketches.

        Of the large keys, only the largest of those that a set searches and the other one is in gives the pair, of
        keys that are not large none if one of those does.
        """
        large = self.large_keys(searching, others)
        # Written, so that both sides of the join below are plain shuffles, of which AQE can split the large ones.
        x, y = (
            saved(
                rows.select("key", "set_id", "component").distinct().join(self.sketches, "set_id")
                .join(self.places(rows, large, side), "set_id", "left")
                .select(
                    "key", *(F.col(c).alias(f"{c}_{side}") for c in ("set_id", "component")), *self.seen(side),
                    *(F.coalesce(f"large_{i}_{side}", F.lit(0).cast("long")).alias(f"large_{i}_{side}") for i in range(LARGE_KEYS // 64)),
                ),
                "apart",
            )
            for rows, side in ((searching, "a"), (others, "b"))
        )
        x = x.join(F.broadcast(large), "key", "left").withColumn("place", F.coalesce("place", F.lit(LARGE_KEYS)))
        words = range(LARGE_KEYS // 64)
        x = x.withColumns({f"large_{i}_a": F.col(f"large_{i}_a").bitwiseAND(self.below(F.col("place"), i)) for i in words}).drop("place")
        before = [F.col(f"large_{i}_a").bitwiseAND(F.col(f"large_{i}_b")) for i in words]
        found = x.alias("x").join(
            y.alias("y"),
            (F.col("x.key") == F.col("y.key")) & (F.col("component_a") != F.col("component_b"))
            & (reduce(Column.bitwiseOR, before) == 0) & self.fits(),
        )
        return found.select("set_id_a", "set_id_b")


def jaccard_components(docs: DataFrame, ngram: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    Two documents link when 100 times their shared shingles are at least `percent` times those of either. Shingles are
    runs of `ngram` words, A to Z in lower case; words are runs of characters other than ASCII white space.
    """
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text_col).alias("text"))
    join = Join(docs, ngram, percent)
    found = join.components().select(F.col("node").alias("set_id"), "component")
    named = join.sizes.join(found, "set_id", "left").select(
        "doc_id", "size", F.coalesce("component", "set_id").alias("component")
    )
    shown = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("doc_id", "doc_id"), ("component", "component_id"))]
    return named.select(shown[0], F.col("size").alias("n_shingles"), shown[1])
