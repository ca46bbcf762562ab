"""Language of texts by cross-parsing against suffix automata.

Every labelled text is folded (lower case, runs of what is no letter as one blank) and cut into pieces; per language the
PIECES of least hash are learnt from, so all labelled text has the same chance and copies count once. A suffix automaton
of these pieces gives the longest match from any place of another text. A text is parsed greedily into such matches;
phrases times the logarithm of the automaton's text length, over the text's length, estimates the entropy of the text
given the language, and the language with the least wins.

The automata are built in one task per language and stored as double arrays, so a step for thousands of stretches of
text at a time is a few array operations. They are sent to the tasks in sets of LANGUAGES_AT_ONCE; texts of more
languages go through once per set, carrying the two least entropies so far. Phrases end after STRETCH bytes at the
latest, alike for all languages.

Defined results: a text that is null or has no letter is `und` with score 0, as is every text when nothing was learnt. A
row without id is not held out and not learnt from. Equal entropies go to the language with more learnt rows, then to
the first by name. Repeated rows are judged each; columns other than those named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved
from shelfwatch.llm.words import text_blocks

# What is learnt from per language: PIECES of at most PIECE_BYTES each.
PIECE_BYTES = 512
PIECES = 192
STRETCH = 512
LANGUAGES_AT_ONCE = 16
SALTS = 64
UNKNOWN = "und"

_BLANK, _BETWEEN = 0x20, b"\0"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = _BLANK
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def fold(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The folded texts in one array, and where each begins (one more at the end)."""
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    data = _FOLD[np.frombuffer(b"".join(texts), np.uint8)]
    blank = data == _BLANK
    before = np.concatenate([[True], blank[:-1]]) if len(data) else blank
    before[begins[:-1][np.diff(begins) > 0]] = True
    keep = ~(blank & before)
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[begins]


# ---- what is learnt from ------------------------------------------------------------------------------------------


def _least_pieces(batches) -> Iterator[pa.RecordBatch]:
    """The pieces of least hash that the task's rows hold, per language."""
    held: dict[str, dict[int, bytes]] = {}
    bound: dict[str, int] = {}

    def cut(lang: str) -> None:
        least = sorted(held[lang])[:PIECES]
        held[lang] = {h: held[lang][h] for h in least}
        if len(least) == PIECES:
            bound[lang] = least[-1]

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for begin, texts in text_blocks(batch):
            data, first = fold(texts)
            data = data.tobytes()
            for i in range(len(texts)):
                lang = langs[begin + i]
                mine, most = held.setdefault(lang, {}), bound.get(lang, 1 << 64)
                for at in range(first[i], first[i + 1], PIECE_BYTES):
                    piece = data[at : min(at + PIECE_BYTES, first[i + 1])]
                    if (h := xxhash.xxh3_64_intdigest(piece)) < most:
                        mine[h] = piece
                if len(mine) > 8 * PIECES:
                    cut(lang)
    for lang in list(held):
        cut(lang)
        pieces = sorted(held[lang].items())
        hashes = np.array([h for h, _ in pieces], np.uint64) ^ np.uint64(1 << 63)  # the same order as Spark's long
        columns = [pa.array([lang] * len(pieces)), pa.array(hashes.view(np.int64)), pa.array([p for _, p in pieces], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "hash", "piece"])


def sample(labelled: DataFrame) -> DataFrame:
    """lang, hash, piece: the PIECES of least hash of each language, from `lang` and `text`."""
    found = labelled.select("lang", "text").mapInArrow(_least_pieces, "lang string, hash long, piece binary")
    found = found.groupBy("lang", "hash").agg(F.min("piece").alias("piece"))
    # Ranked in parts first, so that no task gets what all tasks have found for a language.
    for by in (["lang", F.pmod(F.col("hash"), F.lit(SALTS))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("hash"))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= PIECES).drop("rank")
    return found


# ---- automata -----------------------------------------------------------------------------------------------------


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of each state of the smallest automaton that reads exactly the substrings of the text. State 0 is first."""
    goes, longest, suffix = [{}], [0], [-1]
    last = 0
    for c in text:
        new = len(goes)
        goes.append({})
        longest.append(longest[last] + 1)
        suffix.append(0)
        p = last
        while p >= 0 and c not in goes[p]:
            goes[p][c] = new
            p = suffix[p]
        if p >= 0:
            q = goes[p][c]
            if longest[q] == longest[p] + 1:
                suffix[new] = q
            else:
                twin = len(goes)
                goes.append(dict(goes[q]))
                longest.append(longest[p] + 1)
                suffix.append(suffix[q])
                while p >= 0 and goes[p].get(c) == q:
                    goes[p][c] = twin
                    p = suffix[p]
                suffix[q] = suffix[new] = twin
        last = new
    return goes


class Automaton:
    """Transitions in two arrays: a state is a place, its step by byte c is at place + c, and belongs to it if it says so."""

    def __init__(self, owner: np.ndarray, to: np.ndarray, root: int):
        self.owner, self.to = owner.astype(np.int64), to.astype(np.int64)
        # No step leaves this state, in which every text begins: its first byte opens the first phrase.
        self.nowhere = len(owner) - 256
        steps = root + np.arange(256)
        self.open = np.where(self.owner[steps] == root, self.to[steps], self.nowhere)

    @classmethod
    def of(cls, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        goes = suffix_automaton(text)
        size = 512 + 5 * sum(map(len, goes)) // 2
        owner, place = [-1] * size, [-1] * len(goes)
        taken = bytearray(size)
        tried = 0
        for state in sorted(range(len(goes)), key=lambda s: (-len(goes[s]), s)):
            steps = list(goes[state])
            while True:
                tried = (tried * 1_103_515_245 + 12_345) % (1 << 31)
                at = tried % (size - 256)
                if not taken[at] and all(owner[at + c] < 0 for c in steps):
                    break
            taken[at] = 1
            place[state] = at
            for c in steps:
                owner[at + c] = at
        to = [-1] * (size + 256)
        for state, steps in enumerate(goes):
            for c, target in steps.items():
                to[place[state] + c] = place[target]
        return np.array(owner + [-1] * 256, np.int32), np.array(to, np.int32), place[0]


def _automata(pieces: pa.Table) -> pa.Table:
    rows = sorted(zip(pieces.column("hash").to_pylist(), pieces.column("piece").to_pylist()))
    text = _BETWEEN.join(p for _, p in rows)
    owner, to, root = Automaton.of(text)
    columns = {"lang": [pieces.column("lang")[0].as_py()], "size": [len(text)], "owner": [owner.tobytes()], "to": [to.tobytes()], "root": [root]}
    return pa.table(columns, pa.schema([("lang", pa.string()), ("size", pa.int64()), ("owner", pa.binary()), ("to", pa.binary()), ("root", pa.int64())]))


def learn(labelled: DataFrame) -> DataFrame:
    """One automaton per language of `labelled` (lang, text): lang, rows, size, owner, to, root."""
    labelled = labelled.filter(F.col("lang").isNotNull() & lettered(F.col("text"))).select(F.col("lang").cast("string").alias("lang"), "text")
    rows = labelled.groupBy("lang").agg(F.count("*").alias("rows"))
    made = sample(labelled).groupBy("lang").applyInArrow(_automata, "lang string, size long, owner binary, to binary, root long")
    return made.join(rows, "lang")


# ---- parsing ------------------------------------------------------------------------------------------------------


def phrases(data: np.ndarray, first: np.ndarray, automata: list[Automaton]) -> np.ndarray:
    """How many longest matches each folded text takes, one row per automaton."""
    sizes = np.diff(first)
    counts = -(-sizes // STRETCH)
    text_of = np.repeat(np.arange(len(sizes)), counts)
    part = np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[text_of] + STRETCH * part
    size = np.minimum(STRETCH, first[text_of + 1] - start)
    order = np.argsort(-size, kind="stable")
    text_of, start, size = text_of[order], start[order], size[order]
    running = np.searchsorted(-size, -np.arange(STRETCH), "left")
    misses = np.zeros((len(automata), len(start)), np.int64)
    state = [np.full(len(start), a.nowhere) for a in automata]
    for t in range(int(size.max(initial=0))):
        n = running[t]
        c = data[start[:n] + t].astype(np.int64)
        for k, a in enumerate(automata):
            at = state[k][:n] + c
            miss = a.owner[at] != state[k][:n]
            misses[k, :n] += miss
            state[k][:n] = np.where(miss, a.open[c], a.to[at])
    return np.array([np.bincount(text_of, m, len(sizes)) for m in misses]).reshape(len(automata), len(sizes)).astype(np.int64)


def _judged(models):
    """Adds the languages of the set to what is known of each text: the least entropy, its language, the second least."""

    def rows(batches):
        found = sorted(models.value, key=lambda m: (-m[1], m[0]))
        automata = [Automaton(np.frombuffer(owner, np.int32), np.frombuffer(to, np.int32), root) for _, _, _, owner, to, root in found]
        weight = np.array([math.log2(size + 2) for _, _, size, *_ in found])
        for batch in batches:
            for begin, texts in text_blocks(batch):
                part = batch.slice(begin, len(texts))
                data, first = fold(texts)
                bits = phrases(data, first, automata) * weight[:, None] / np.maximum(1, np.diff(first))
                langs, least, second, learnt = (part.column(c).to_pylist() for c in ("best", "least", "second", "learnt"))
                for i in range(len(texts)):
                    for (lang, n, *_), h in zip(found, bits[:, i].tolist()):
                        if langs[i] is None or (h, -n, lang) < (least[i], -learnt[i], langs[i]):
                            langs[i], least[i], learnt[i], second[i] = lang, h, n, least[i]
                        elif second[i] is None or h < second[i]:
                            second[i] = h
                columns = [part.column(c) for c in ("doc_id", "held_out", "text", "lettered")]
                columns += [pa.array(langs, pa.string()), pa.array(least, pa.float64()), pa.array(second, pa.float64()), pa.array(learnt, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in KNOWN.split(", ")])

    return rows


KNOWN = "doc_id long, held_out boolean, text string, lettered boolean, best string, least double, second double, learnt long"


def lettered(text: Column) -> Column:
    """Whether the text has a letter; false for null."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, models: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for `docs` (doc_id, held_out, text), by the automata that `learn` gives."""
    spark = docs.sparkSession
    nothing = {"best": "string", "least": "double", "second": "double", "learnt": "long"}
    # Case is folded by the JVM; only texts with letters are sent on to be parsed.
    known = docs.select("doc_id", "held_out", F.lower("text").alias("text"), lettered(F.col("text")).alias("lettered"))
    known = known.withColumn("text", F.when(F.col("lettered"), F.col("text")))
    known = known.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    langs = sorted(r.lang for r in models.select("lang").collect())
    for at in range(0, len(langs), LANGUAGES_AT_ONCE):
        some = models.filter(F.col("lang").isin(langs[at : at + LANGUAGES_AT_ONCE])).select("lang", "rows", "size", "owner", "to", "root")
        sent = spark.sparkContext.broadcast([tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in some.collect()])
        known = known.mapInArrow(_judged(sent), KNOWN)
        if at + LANGUAGES_AT_ONCE < len(langs):
            known = saved(known, "languages-so-far")
    sure = F.col("lettered") & F.col("best").isNotNull()
    margin = F.when(F.col("second").isNull(), 1.0).when(F.col("second") > 0, 1 - F.col("least") / F.col("second")).otherwise(0.0)
    return known.select(
        "doc_id", "held_out", F.when(sure, F.col("best")).otherwise(UNKNOWN).alias("lang_pred"), F.when(sure, margin).otherwise(0.0).alias("score")
    )


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Learns from the labelled documents outside the fold `held_out` by crc32 of the id, and judges every document."""
    fold_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    models = saved(learn(docs.filter(fold_of != held_out).select("lang", "text")), "languages")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold_of == held_out, F.lit(False)).alias("held_out"), "text")
    return predict(rows, models)
