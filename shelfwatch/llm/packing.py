"""Packing of token sequences, best fit first, then a local search by moves and swaps.

Documents are tokenised in the tasks, every distinct word of a block once. Only documents longer than a sequence are
cut. Pieces are packed in bounded groups: best fit from the longest piece down, then the local search takes the
emptiest bins in turn and moves their pieces into other underfull bins, alone, in exchange for one smaller piece, two
for one, or one for two, always so that the sum of squared fills rises, until the bin is empty or nothing helps. Bins
still underfull are dealt anew into groups by their number and packed again; the number of such rounds and the group
size are fixed, so no task ever holds more than one group, whatever the lengths are. The search gives up a group after
FUTILE_BINS bins in a row that it could not empty, and looks at BINS_LOOKED_AT others per step.

Defined results: a null or empty text is the closing id alone; repeated rows are packed each; a null id is kept;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved
from shelfwatch.llm.workers import kept, let_go, tidy

CLOSING_ID = 0
GROUP_PIECES = 40_000
REGROUPINGS = 2
WORDS_KEPT = 1_000_000
# New words that the tokenizer reads as one text, and in one call.
WORDS_AT_ONCE = 100
NEW_AT_ONCE = 10_000
BLOCK_CHARS = 4_000_000
# Search effort per group: bins looked at in a step, and bins in a row that nothing can be done for.
BINS_LOOKED_AT = 300
FUTILE_BINS = 30


# ---- tokens -------------------------------------------------------------------------------------------------------


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds(dict):
    """Ids of words between blanks, as little-endian bytes. The tokenizer never joins anything across a blank."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = _tokenizer(path)

    @classmethod
    def shared(cls, path: str) -> WordIds:
        """The one of this Python worker, which serves many tasks, until another operator's come."""
        return kept((cls, path), lambda: cls(path))

    def of(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self) > WORDS_KEPT:
            self.clear()
        new = list(set().union(*split).difference(self))
        for at in range(0, len(new), NEW_AT_ONCE):
            self._learn(new[at : at + NEW_AT_ONCE])
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        return [b"".join(map(self.__getitem__, s)) + closing for s in split]


    def _learn(self, words: list[str]) -> None:
        """Ids of words from texts of many: a token belongs to the word in which it begins."""
        groups = [words[at : at + WORDS_AT_ONCE] for at in range(0, len(words), WORDS_AT_ONCE)]
        for group, found in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4").tobytes()
            ends = np.cumsum([len(w) + 1 for w in group])
            begins = np.fromiter(chain.from_iterable(found.offsets), np.int64, len(ids) // 2)[::2]
            cuts = (4 * np.searchsorted(begins, ends)).tolist()
            at = 0
            for word, cut in zip(group, cuts):
                self[word] = ids[at:cut]
                at = cut


def _blocks(texts):
    begin, size, out = 0, 0, []
    for i, text in enumerate(texts):
        text = text.as_py() or ""
        if out and size + len(text) > BLOCK_CHARS:
            yield begin, out
            begin, size, out = i, 0, []
        out.append(text)
        size += len(text)
    if out:
        yield begin, out


def _piece_rows(path: str, length: int, with_ids: bool):
    @tidy
    def rows(batches):
        known = WordIds.shared(path)
        for batch in batches:
            ids = batch.column("doc_id")
            for begin, texts in _blocks(batch.column("text")):
                out = defaultdict(list)
                for i, found in enumerate(known.of(texts)):
                    for piece, at in enumerate(range(0, len(found), 4 * length)):
                        part = found[at : at + 4 * length]
                        out["doc_id"].append(ids[begin + i].as_py())
                        out["piece"].append(piece)
                        out["start"].append(at // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                        if with_ids:
                            out["ids"].append(part)
                schema = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
                yield pa.RecordBatch.from_pydict(dict(out), pa.schema(schema + [("ids", pa.binary())] * with_ids))

    return rows


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32, and if asked for the ids themselves."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_piece_rows(tokenizer, length, with_ids), PIECES + ", ids binary" * with_ids)


# ---- bins ---------------------------------------------------------------------------------------------------------


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of piece numbers: each piece, the longest first, into the fullest bin it fits in."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = defaultdict(list)
    some = 0  # bit f: a bin with f free places
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = some >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
            bins[b].append(i)
        else:
            free, b = length, len(bins)
            bins.append([i])
        by_free[free - size].append(b)
        some |= 1 << (free - size)
    return bins


class Search:
    """Local search among the underfull bins of a group. Holds their pieces in arrays, a bin per row."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], length: int):
        self.sizes, self.bins, self.length = sizes, bins, length
        self.fill = np.array([int(sizes[b].sum()) for b in bins], np.int64)

    def run(self) -> list[list[int]]:
        least = -(-int(self.fill.sum()) // self.length)
        left, futile = len(self.bins), 0
        for source in np.argsort(self.fill, kind="stable").tolist():
            if left == least or futile == FUTILE_BINS:
                break
            while 0 < self.fill[source] < self.length and self._step(source):
                pass
            emptied = not self.fill[source]
            left, futile = left - emptied, 0 if emptied else futile + 1
        return [b for b in self.bins if b]

    def _view(self, source: int):
        """Other underfull bins, the emptiest first, and their pieces: number and bin."""
        targets = np.flatnonzero((self.fill < self.length) & (self.fill >= self.fill[source]))
        targets = targets[targets != source]
        targets = targets[np.argsort(self.fill[targets], kind="stable")[:BINS_LOOKED_AT]]
        held = [self.bins[t] for t in targets]
        bin_of = np.repeat(targets, [len(h) for h in held])
        piece = np.array([p for h in held for p in h], np.int64)
        return targets, piece, bin_of

    def _step(self, source: int) -> bool:
        """One exchange that raises the squared fills the most among the kinds tried, or False."""
        targets, piece, bin_of = self._view(source)
        if not len(targets):
            return False
        own = sorted(self.bins[source], key=lambda p: -self.sizes[p])
        groups = [(p,) for p in own] + [(p, q) for i, p in enumerate(own[:12]) for q in own[i + 1 : 12]]
        free = self.length - self.fill
        best = (0, None, None, None)
        for out in groups:
            amount = int(sum(self.sizes[p] for p in out))
            fits = targets[free[targets] >= amount]  # a move
            if len(fits):
                to = int(fits[np.argmax(self.fill[fits])])
                best = max(best, (self._gain(source, to, amount), out, to, ()), key=lambda x: x[0])
            more = amount - self.sizes[piece]  # one piece, or two, for one
            ok = np.flatnonzero((more > 0) & (free[bin_of] >= more))
            if len(ok):
                gain = self._gain(source, bin_of[ok], more[ok])
                k = int(np.argmax(gain))
                best = max(best, (int(gain[k]), out, int(bin_of[ok[k]]), (int(piece[ok[k]]),)), key=lambda x: x[0])
        if best[1] is None or best[0] <= 0:
            best = self._one_for_two(source, own, targets, free)
            if best[0] <= 0:
                return False
        _, out, to, back = best
        change = int(sum(self.sizes[p] for p in out) - sum(self.sizes[p] for p in back))
        self.bins[source] = [p for p in self.bins[source] if p not in out] + list(back)
        self.bins[to] = [p for p in self.bins[to] if p not in back] + list(out)
        self.fill[source] -= change
        self.fill[to] += change
        return True

    def _gain(self, source, to, amount):
        """How much the sum of squared fills rises if `amount` goes from one bin to the other."""
        return 2 * amount * (self.fill[to] - self.fill[source] + amount)

    def _one_for_two(self, source, own, targets, free):
        best = (0, None, None, None)
        for to in targets[:64].tolist():
            held = np.array(self.bins[to])
            a, b = np.triu_indices(len(held), 1)
            pair = self.sizes[held[a]] + self.sizes[held[b]]
            for p in own:
                more = self.sizes[p] - pair
                ok = np.flatnonzero((more > 0) & (more <= free[to]))
                if len(ok):
                    k = ok[np.argmax(more[ok])]
                    gain = int(self._gain(source, to, int(more[k])))
                    best = max(best, (gain, (p,), to, (int(held[a[k]]), int(held[b[k]]))), key=lambda x: x[0])
        return best


def pack(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of piece numbers for one group."""
    return Search(sizes, best_fit(sizes, length), length).run()


def _packed_rows(length: int, round_number: int, last: bool):
    """Adds sequence_id, offset, and whether the sequence is to be packed again."""

    def packed(table: pa.Table, base: int):
        sizes = table.column("length").to_numpy()
        bins = pack(sizes, length)
        order = np.concatenate([np.array(b, np.int64) for b in bins])
        counts = [len(b) for b in bins]
        fill = np.array([sizes[b].sum() for b in bins])
        moved = np.cumsum(sizes[order]) - sizes[order]
        offset = moved - np.repeat(np.cumsum(fill) - fill, counts)
        table = table.take(pa.array(order))
        again = np.zeros(len(bins), bool) if last else fill < length
        return (
            table.append_column("sequence_id", pa.array(np.repeat(base + np.arange(len(bins)), counts)))
            .append_column("offset", pa.array(offset))
            .append_column("again", pa.array(np.repeat(again, counts)))
        )

    @tidy
    def rows(batches):
        let_go()
        held, n, group = [], 0, 0
        task = TaskContext.get().partitionId()

        def done():
            base = (round_number << 60) + (task << 36) + group * GROUP_PIECES
            return packed(pa.Table.from_batches(held), base).to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_PIECES):
                part = batch.slice(at, GROUP_PIECES)
                if n + part.num_rows > GROUP_PIECES:
                    yield from done()
                    held, n, group = [], 0, group + 1
                held.append(part)
                n += part.num_rows
        if n:
            yield from done()

    return rows


def pack_sequences(found: DataFrame, length: int = 2048) -> DataFrame:
    """Pieces with the sequence each belongs to and its place there, which has no gaps.

    `found` has a column `length` of at most `length`; its columns are kept, and sequence_id and offset added.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    columns = found.columns
    whole = found.filter(F.col("length") == length)
    rest = found.filter(F.col("length") < length)
    out = [_alone(whole, length)]
    for number in range(REGROUPINGS + 1):
        last = number == REGROUPINGS
        groups = max(1, -(-rest.count() // GROUP_PIECES))
        # Dealt by all columns, so every group gets the same mix of lengths, and a lost task the same rows again.
        dealt = rest.repartition(groups, F.xxhash64(*columns, F.lit(number)))
        packed = saved(
            dealt.mapInArrow(_packed_rows(length, number + 1, last), f"{schema}, sequence_id long, offset long, again boolean"),
            "packed",
        )
        out.append(packed.filter("NOT again").drop("again"))
        rest = packed.filter("again").select(*columns)
    for more in out[1:]:
        out[0] = out[0].unionByName(more)
    return out[0]


def _alone(whole: DataFrame, length: int) -> DataFrame:
    """A piece that fills a sequence is one."""
    return whole.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def pack_documents(docs: DataFrame, tokenizer: str, length: int = 2048, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_sequences(saved(pieces(docs, tokenizer, length, with_ids), "pieces"), length)
