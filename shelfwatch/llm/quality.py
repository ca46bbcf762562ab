"""Quality and toxicity of documents: a weak-label model, whose posterior labels train a hashed linear scorer.

Overlapping heuristics vote on every document: bad, good, or no opinion. Only how often each pattern of votes occurs
leaves the tasks (at most three to the number of labellers), and expectation maximisation over these counts estimates
each labeller's accuracies and every pattern's posterior. Annotated labels, where there are any, are one more labeller.
Two heuristics against toxicity use words and word beginnings that annotated toxic rows have far more often.

A linear scorer on hashed features (words, word beginnings, steps of the documents' statistics) learns the posteriors
of two bounded samples, of annotated rows and of others, and then scores every document. An annotation decides for its
row; what the scorer learns of kinds of junk that no annotated row shows comes from the votes on the others. All
statistics and votes are of whole texts.

Defined results: a null or empty text has no features and is never rejected, nor is any other text without a feature
that the scorer weighs, as nothing but the bias speaks against it. Without annotated rows there is nothing to fit: documents are judged by the votes' posteriors.
Labels that are null give no opinion; of several for one id the worst counts. Repeated rows are scored each; a null id
is kept. Other columns are ignored by `score_documents` and kept by `keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved, small
from shelfwatch.llm.words import NOT_ALNUM, SPACE, combine, mix, text_blocks, words_of
from shelfwatch.llm.workers import tidy

# The bound of each training sample: annotated rows, and others.
TRAINING_ROWS = 10_000
BUCKETS = 1 << 18
FEATURES = 8192
BEGINNING = 5
NONE, GOOD, BAD = 0, 1, 2
# Posteriors from here on tell which features are chosen.
SURE = 0.9
# How often an annotation is taken to be right.
ANNOTATED = 0.995
# Votes every heuristic is taken to have cast before any is counted (none, good, bad), on good and on bad documents: most
# bad documents are bad in one way only, so half of the heuristics' votes on them are good. They hold labellers above
# chance and one bad vote among many good ones below the limit until counts say otherwise.
ASSUMED_VOTES = np.array([[0.5, 9.0, 0.5], [0.5, 4.75, 4.75]])
ASSUMED_CLASSES = np.array([8.0, 2.0])
# Stretches of the samples' features that are added up at a time, which bounds the driver's memory.
FEATURES_AT_ONCE = 1 << 20

# Common English insults, in lower case.
INSULTS = (
    "clown disgusting dumb fool garbage idiot idiotic idiots imbecile jerk loser losers moron moronic morons pathetic scum stupid trash "
    "vermin worthless"
).split()
# Frequent function words of the four languages.
FUNCTION_WORDS = (
    "a al als an and are as at auf be by con das dans de del der des die du ein el en est et for from have in is ist it la las le les los "
    "mit nicht no of on or para por pour que se sich sur that the this to un una und une von was with y zu"
).split()


@dataclass
class Lexicon:
    """Hashed features that toxic rows have far more often, as marks over the buckets: words and word beginnings."""

    words: np.ndarray
    beginnings: np.ndarray


def _hash_of(words: list[str]) -> np.ndarray:
    return np.unique(words_of([" ".join(words).encode()], NOT_ALNUM, lower=True).hash)


INSULT_HASHES, FUNCTION_HASHES = _hash_of(INSULTS), _hash_of(FUNCTION_WORDS)


class Block:
    """Statistics and features of some texts."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        raw = words_of(texts, SPACE)
        low = words_of(texts, NOT_ALNUM, lower=True)
        text, n_words = low.text_of(), np.maximum(low.counts, 1)
        per = lambda marks: np.bincount(text, weights=marks, minlength=self.n)
        order = np.lexsort((low.hash, text))
        value, of = low.hash[order], text[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
        run = np.diff(np.append(np.flatnonzero(new), len(value)))
        self.word, self.word_text = value[new], of[new]
        top = np.zeros(self.n)
        np.maximum.at(top, self.word_text, run)
        again = np.zeros(len(low.hash))
        again[1:] = (low.hash[1:] == low.hash[:-1]) & (text[1:] == text[:-1])
        data = raw.data
        at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        share = lambda table: np.add.reduceat(table[data].astype(np.int64), at[:-1]) if self.n else np.zeros(0)
        upper = share(_UPPER)
        letters = np.maximum(upper + share(_LOWER), 1)
        lines = [t.split(b"\n") for t in texts]
        self.stats = {
            "distinct": np.bincount(self.word_text, minlength=self.n) / n_words,
            "top": top / n_words,
            "again": per(again) / n_words,
            "upper": upper / letters,
            "symbols": share(_SYMBOL) / np.maximum(np.diff(at), 1),
            "shouts": share(_SHOUT) / np.maximum(raw.counts, 1),
            "function": per(np.isin(low.hash, FUNCTION_HASHES)) / n_words,
            "length": per((low.end - low.start).astype(float)) / n_words,
            "lines": np.array([1 - len(set(x)) / len(x) for x in lines]),
            "bars": share(_BAR) / np.maximum(raw.counts, 1),
        }
        self.words = low.counts
        size = low.end - low.start
        first = np.stack([low.data[np.minimum(low.start + k, len(low.data) - 1)] for k in range(BEGINNING)], 1).astype(np.uint64)
        begun = np.zeros(len(size), np.uint64)
        for k in range(BEGINNING):
            begun = (begun << np.uint64(8)) | first[:, k]
        long = size > BEGINNING
        self.begun_text, self.begun = np.divmod(np.unique(text[long] * BUCKETS + bucket_of(mix(begun[long] ^ np.uint64(0xBE61)))), BUCKETS)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket), each once: words, beginnings and the steps of statistics."""
        text, bucket = [self.word_text, self.begun_text], [bucket_of(self.word), self.begun]
        some = np.flatnonzero(self.words > 0)
        for k, x in enumerate(self.stats.values()):
            step = np.digitize(x[some], _STEPS[k])
            text.append(some)
            bucket.append(bucket_of(combine(np.full(len(some), k + 1, np.uint64), step.astype(np.uint64))))
        return np.divmod(np.unique(np.concatenate(text) * BUCKETS + np.concatenate(bucket)), BUCKETS)

    def hits(self, lexicon: Lexicon | None) -> dict[str, np.ndarray]:
        count = lambda text, marks: np.bincount(text[marks], minlength=self.n)
        none = np.zeros(self.n, np.int64)
        return {
            "insults": count(self.word_text, np.isin(self.word, INSULT_HASHES)),
            "words": none if lexicon is None else count(self.word_text, lexicon.words[bucket_of(self.word)]),
            "beginnings": none if lexicon is None else count(self.begun_text, lexicon.beginnings[self.begun]),
        }


def bucket_of(value: np.ndarray) -> np.ndarray:
    return (value & np.uint64(BUCKETS - 1)).astype(np.int64)


def _table(characters) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(characters)] = 1
    return out


_UPPER, _LOWER = _table(range(65, 91)), _table(range(97, 123))
_SYMBOL, _SHOUT, _BAR = _table(b"#@$%^&*<>|{}~\\"), _table(b"!"), _table(b"|")
# Steps of the statistics, in their order.
_STEPS = [
    [0.1, 0.3, 0.45, 0.55, 0.65], [0.08, 0.15, 0.25], [0.02, 0.05, 0.2], [0.06, 0.15, 0.4], [0.003, 0.02, 0.08], [0.05, 0.3, 1.0],
    [0.01, 0.03, 0.08, 0.12, 0.3, 0.4], [3.0, 4.0, 6.5, 9.0], [0.15, 0.4, 0.7], [0.05, 0.3],
]


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


def quality_votes(block: Block) -> list[np.ndarray]:
    s, enough = block.stats, block.words >= 20
    votes = [
        _vote(enough & (s["distinct"] < 0.3), s["distinct"] > 0.5),
        _vote(enough & (s["top"] > 0.25), s["top"] < 0.12),
        _vote(enough & (s["again"] > 0.2), s["again"] < 0.04),
        _vote(s["upper"] > 0.4, s["upper"] < 0.1),
        _vote(s["symbols"] > 0.03, s["symbols"] < 0.004),
        _vote(s["shouts"] > 0.5, s["shouts"] < 0.1),
        _vote(False, s["function"] > 0.08),  # other languages have function words of their own
        _vote(enough & (s["lines"] > 0.6), s["lines"] < 0.2),
    ]
    return [np.where(block.words > 0, v, NONE) for v in votes]


def toxicity_votes(block: Block, lexicon: Lexicon | None) -> list[np.ndarray]:
    votes = []
    for name, n in block.hits(lexicon).items():
        if name == "insults" or lexicon is not None:
            votes.append(np.where(block.words > 0, _vote(n > 1, n == 0), NONE))
    return votes


def pattern_of(votes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(votes[0]), np.int64)
    for v in votes:
        out = out * 3 + v
    return out


# ---- label model --------------------------------------------------------------------------------------------------


def posteriors(patterns: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of each pattern, and per labeller and class the probabilities of its three votes, by EM.

    The last labeller is the annotation: its silence says nothing; where it speaks, it decides, which holds the classes
    to what annotators mean by them. A heuristic's silence is a vote like the others. Starts from the rule that a bad
    vote or two outweigh the good ones; pseudo-counts keep what is never seen possible.
    """
    votes = np.stack([patterns // 3 ** (labellers - 1 - k) % 3 for k in range(labellers)], axis=1)
    annotated = votes[:, -1]
    known = np.select([annotated == BAD, annotated == GOOD], [ANNOTATED, 1 - ANNOTATED], np.nan)
    bad = np.where(np.isnan(known), np.minimum(0.05 + 0.45 * (votes[:, :-1] == BAD).sum(1), 0.95), known)
    post = np.stack([1 - bad, bad], axis=1)
    said = np.zeros((2, labellers, 3))
    for _ in range(rounds):
        weight = post * counts[:, None]
        prior = (weight.sum(0) + ASSUMED_CLASSES) / (weight.sum() + ASSUMED_CLASSES.sum())
        for k in range(labellers):
            seen = np.stack([np.bincount(votes[:, k], weights=weight[:, c], minlength=3) for c in (0, 1)]) + ASSUMED_VOTES
            said[:, k] = seen / seen.sum(1, keepdims=True)
            if said[1, k, BAD] <= said[0, k, BAD]:
                said[:, k] = seen.sum(0) / seen.sum()
        each = np.stack([said[c][np.arange(labellers), votes][:, :-1] for c in (0, 1)])
        log = np.log(prior)[:, None] + np.log(each).sum(2)
        post = np.exp(log - log.max(0)).T
        post /= post.sum(1, keepdims=True)
        post[~np.isnan(known)] = np.stack([1 - known, known], axis=1)[~np.isnan(known)]
    return post[:, 1], said


def train(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, width: int, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic scorer (the bias last) on sparse rows of ones, by accelerated gradient steps."""
    n = len(target)
    parts = [slice(at, at + FEATURES_AT_ONCE) for at in range(0, len(rows), FEATURES_AT_ONCE)]
    weight, moved, step = np.zeros(width + 1), np.zeros(width + 1), 1.0
    most = np.bincount(rows, minlength=n).max(initial=0) + 1
    rate = 4.0 / most
    balance = np.where(target > 0.5, (target <= 0.5).sum() + 1, (target > 0.5).sum() + 1).astype(float)
    balance = np.clip(balance / balance.mean(), 0.2, 5)
    balance /= balance.sum()
    for _ in range(rounds):
        score = sum((np.bincount(rows[p], weights=moved[columns[p]], minlength=n) for p in parts), np.zeros(n)) + moved[-1]
        error = (1 / (1 + np.exp(-score)) - target) * balance
        slope = sum((np.bincount(columns[p], weights=error[rows[p]], minlength=width) for p in parts), np.zeros(width))
        slope = np.append(slope, error.sum()) + 2e-5 * moved
        after = moved - rate * slope
        following = (1 + np.sqrt(1 + 4 * step**2)) / 2
        moved = after + (step - 1) / following * (after - weight)
        weight, step = after, following
    return weight


# ---- over Spark ---------------------------------------------------------------------------------------------------


@tidy
def _sample_features(batches):
    for batch in batches:
        for begin, texts in text_blocks(batch):
            text, bucket = Block(texts).features()
            first = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(first, pa.array(bucket.astype(np.int32)))
            names = ["doc_id", "hash", "quality", "toxic", "known"]
            labels = [batch.column(c).slice(begin, len(texts)) for c in names]
            yield pa.RecordBatch.from_arrays([*labels, lists], [*names, "features"])


def _vote_rows(lexicon):
    @tidy
    def rows(batches):
        for batch in batches:
            for begin, texts in text_blocks(batch):
                block = Block(texts)
                known = None if lexicon is None else lexicon.value
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, len(texts)),
                        batch.column("hash").slice(begin, len(texts)),
                        pa.array(pattern_of(quality_votes(block))),
                        pa.array(pattern_of(toxicity_votes(block, known))),
                    ],
                    ["doc_id", "hash", "quality_votes", "toxicity_votes"],
                )

    return rows


def _scores(model):
    def rows(batches):
        for batch in batches:
            for begin, texts in text_blocks(batch):
                text, bucket = Block(texts).features()
                out = [batch.column("doc_id").slice(begin, len(texts))]
                for weight, bias in model.value:
                    some = np.bincount(text, weights=weight[bucket] != 0, minlength=len(texts)) > 0
                    score = np.bincount(text, weights=weight[bucket], minlength=len(texts)) + bias
                    out.append(pa.array(np.where(some, 1 / (1 + np.exp(-np.clip(score, -500, 500))), 0.0)))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "p_bad", "p_toxic"])

    return rows


def _labelled(labels: DataFrame) -> DataFrame:
    """One row per annotated id: votes on quality and toxicity."""
    vote = lambda bad, good: F.when(bad, BAD).when(good, GOOD).otherwise(NONE)
    votes = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        vote(F.col("quality") == 0, F.col("quality") == 1).alias("quality"), vote(F.col("toxic") == 1, F.col("toxic") == 0).alias("toxic"),
    )
    return votes.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")).filter("doc_id IS NOT NULL")


class Sample:
    """The training rows: ids, hashes of texts, annotations, and their features as (row, bucket)."""

    def __init__(self, found: DataFrame, training_rows: int):
        # Rows that repeat an id don't raise the bound.
        parts = [found.filter(k).orderBy("doc_id", "hash").limit(training_rows).toArrow() for k in ("known", "NOT known AND size(features) > 0")]
        table = pa.concat_tables(parts if parts[0].num_rows else parts[:1])
        del parts
        self.ids, self.hash, self.quality, self.toxic = (table.column(c).to_numpy() for c in ("doc_id", "hash", "quality", "toxic"))
        # The narrowest types and no second copy: this is what takes most of the driver's memory.
        chunks = table.column("features").chunks
        sizes = np.concatenate([np.zeros(0, np.int64), *(c.value_lengths().to_numpy() for c in chunks)]).astype(np.int64)
        kind = np.uint16 if len(sizes) <= 1 << 16 else np.int32
        self.row = np.repeat(np.arange(len(sizes), dtype=kind), sizes)
        self.bucket = np.concatenate([np.zeros(0, np.int32), *(c.flatten().to_numpy() for c in chunks)])

    def placed(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and places of the features that have one."""
        rows, places = [self.row[:0]], [place[:0]]
        for at in range(0, len(self.row), FEATURES_AT_ONCE):
            found = place[self.bucket[at : at + FEATURES_AT_ONCE]]
            some = found >= 0
            rows.append(self.row[at : at + FEATURES_AT_ONCE][some])
            places.append(found[some])
        return np.concatenate(rows), np.concatenate(places)

    def association(self, votes: np.ndarray) -> np.ndarray:
        """Per bucket, how many deviations more often rows voted bad have it."""
        n = np.array([(votes == GOOD).sum(), (votes == BAD).sum()], float)
        if not n.all():
            return np.zeros(BUCKETS)
        has = np.zeros((2, BUCKETS), np.int64)
        for at in range(0, len(self.row), FEATURES_AT_ONCE):
            said, bucket = votes[self.row[at : at + FEATURES_AT_ONCE]], self.bucket[at : at + FEATURES_AT_ONCE]
            has += [np.bincount(bucket[said == v], minlength=BUCKETS) for v in (GOOD, BAD)]
        share = (has[0] + has[1] + 0.5) / (n.sum() + 1)
        return (has[1] / n[1] - has[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))


class Model:
    """What is learnt from a corpus: the posteriors of vote patterns and the scorers' weights."""

    def __init__(self, docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS):
        self.spark = docs.sparkSession
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))
        labelled = saved(_labelled(labels), "labels")
        # The samples have a documented bound, so they may be sent to every task.
        order = (F.xxhash64("doc_id"), "doc_id")
        sample = labelled.orderBy(*order).limit(training_rows).withColumn("known", F.lit(True))
        others = docs.select("doc_id").filter("doc_id IS NOT NULL").join(small(labelled), "doc_id", "left_anti").orderBy(*order).limit(training_rows)
        silent = [F.lit(NONE).alias(c) for c in ("quality", "toxic")]
        sample = sample.union(others.distinct().select("doc_id", *silent, F.lit(False)))
        drawn = docs.join(F.broadcast(saved(sample, "sample")), "doc_id")
        found = drawn.mapInArrow(_sample_features, "doc_id long, hash long, quality int, toxic int, known boolean, features array<int>")
        sample = Sample(saved(found, "features"), training_rows)
        votes = docs.mapInArrow(_vote_rows(self._lexicon(sample)), "doc_id long, hash long, quality_votes long, toxicity_votes long")
        self.votes = saved(votes, "votes")
        pairs = self.votes.join(labelled, "doc_id", "left")
        self.has_lexicon = len(sample.ids) > 0
        self.accuracies, self.posterior = {}, {}
        for name, column, count in (("bad", "quality", 8), ("toxic", "toxicity", 3 if self.has_lexicon else 1)):
            label = F.coalesce("quality" if name == "bad" else "toxic", F.lit(NONE))
            pattern = (F.col(f"{column}_votes") * 3 + label).alias("pattern")
            counted = pairs.groupBy(pattern).agg(F.count("*").alias("n")).collect()  # bounded by 3 to the labellers
            patterns, n = (np.array([r[k] for r in counted], np.int64) for k in (0, 1))
            post, self.accuracies[name] = posteriors(patterns, n, count + 1) if len(patterns) else (np.zeros(0), None)
            self.posterior[name] = dict(zip(patterns.tolist(), post.tolist()))
        self.pairs = pairs
        self.weights = self._weights(sample, pairs)

    def _lexicon(self, sample):
        if not len(sample.ids):
            return None
        high = sample.association(sample.toxic) > 6
        return self.spark.sparkContext.broadcast(Lexicon(high, high))

    def _weights(self, sample, pairs):
        if not len(sample.ids):
            return None
        ids = self.spark.createDataFrame([(int(i),) for i in np.unique(sample.ids)], "doc_id long")
        drawn = pairs.join(F.broadcast(ids), "doc_id").distinct().collect()
        rows = {(r.doc_id, r.hash): r for r in drawn}
        drawn = [rows[k] for k in zip(sample.ids.tolist(), sample.hash.tolist())]
        out = []
        for name, votes, label in (("bad", "quality_votes", "quality"), ("toxic", "toxicity_votes", "toxic")):
            target = np.array([self.posterior[name][r[votes] * 3 + (r[label] or NONE)] for r in drawn])
            strength = np.abs(sample.association(np.select([target >= SURE, target <= 1 - SURE], [BAD, GOOD], NONE)))
            chosen = np.sort(np.argsort(-strength, kind="stable")[:FEATURES])
            chosen = chosen[strength[chosen] > 4]
            place = np.full(BUCKETS, -1, np.int16 if FEATURES <= 1 << 15 else np.int32)
            place[chosen] = np.arange(len(chosen))
            fitted = train(*sample.placed(place), target, len(chosen))
            weight = np.zeros(BUCKETS)
            weight[chosen] = fitted[:-1]
            out.append((weight, fitted[-1]))
        return out

    def score(self, docs: DataFrame) -> DataFrame:
        if self.weights is None:
            return self._by_votes()
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return docs.mapInArrow(tidy(_scores(self.spark.sparkContext.broadcast(self.weights))), "doc_id long, p_bad double, p_toxic double")

    def _by_votes(self) -> DataFrame:
        out = self.votes.select("doc_id", (F.col("quality_votes") * 3).alias("q"), (F.col("toxicity_votes") * 3).alias("t"))
        for name, column in (("bad", "q"), ("toxic", "t")):
            known = self.spark.createDataFrame(list(self.posterior[name].items()), f"{column} long, p_{name} double")
            out = out.join(F.broadcast(known), column, "left")
        nothing = {"bad": 0, "toxic": 0}  # a pattern without any opinion says nothing against a document
        return out.select("doc_id", *(F.when(F.col(c) == nothing[n], 0.0).otherwise(F.coalesce(f"p_{n}", F.lit(0.0))).alias(f"p_{n}") for n, c in (("bad", "q"), ("toxic", "t"))))


def score_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.5, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Per document: doc_id, p_bad, p_toxic, rejected (either is `limit` or more)."""
    found = Model(docs, labels, training_rows).score(docs)
    return found.withColumn("rejected", (F.col("p_bad") >= limit) | (F.col("p_toxic") >= limit))


def keep_good(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents that aren't rejected, with all their columns. Texts are judged where they are read."""
    model = Model(docs, labels)
    if model.weights is None:
        gone = model.score(docs).filter((F.col("p_bad") >= limit) | (F.col("p_toxic") >= limit)).select(F.col("doc_id").alias("_gone"))
        gone = small(saved(gone.distinct(), "rejected"))
        return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_gone"]), "left_anti")
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    @tidy
    def kept(batches):
        score = _scores(weights)
        for batch in batches:
            few = batch.select(["doc_id", "text"])
            found = pa.Table.from_batches(list(score([few])), pa.schema(_SCORES))
            worst = np.maximum(found.column("p_bad").to_numpy(), found.column("p_toxic").to_numpy())
            yield batch.filter(pa.array(worst < limit))

    return docs.mapInArrow(kept, docs.schema)


_SCORES = [("doc_id", pa.int64()), ("p_bad", pa.float64()), ("p_toxic", pa.float64())]
