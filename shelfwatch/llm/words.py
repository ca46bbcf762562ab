"""Words of whole texts as 64-bit hashes, for a block of texts at a time.

Works on the UTF-8 bytes with numpy inside Spark tasks. A word is a run of bytes that are not separators; every
separator used here is ASCII, so runs of bytes and runs of characters are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from shelfwatch.llm.workers import let_go

BLOCK_BYTES = 4 << 20
LONG_WORD = 64

# The separators of the two kinds of words.
SPACE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
NOT_ALNUM = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTES_KEPT = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0xC2B2AE3D27D4EB4F)))


@dataclass
class Words:
    """Words of some texts: bytes, hash and place of each word, and where each text's words begin (one more at the end)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def left(self) -> np.ndarray:
        """How many words of its text follow from each word on, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hash))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    size = end - start
    out = mix(size.astype(np.uint64) + np.uint64(seed * 0x5851F42D4C957F2D % 2**64))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    live = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(live := live[size[live] > at]):
        part = eights[start[live] + at] & _BYTES_KEPT[np.minimum(size[live] - at, 8)]
        out[live] = combine(out[live], part)
        at += 8
    for i in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


def words_of(texts: list[bytes], separators: list[int], lower: bool = False, seed: int = 1) -> Words:
    """The words of each text. `lower` lower-cases A to Z first."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)  # every separator set has the line end
    if lower:
        data = _LOWER[data]
    is_word = np.ones(256, bool)
    is_word[separators] = False
    inside = is_word[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, end = edge[0::2], edge[1::2]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    return Words(data, start, end, np.searchsorted(start, begins), _hashes(data, start, end, seed))


def count_words(text: bytes, separators: list[int], lower: bool = False) -> int:
    """How many words the text has."""
    is_word = np.ones(256, bool)
    is_word[separators] = False
    inside = (is_word[_LOWER] if lower else is_word)[np.frombuffer(text, np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[:1].sum())


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each place on; the last k - 1 places have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width = hashes, 1
    done, covered = None, 0
    while True:
        if k & width:
            done = power[covered : covered + n] if done is None else combine(done, power[covered : covered + n])
            covered += width
        if covered == k:
            return mix(done + np.uint64(k))
        power = combine(power[: len(power) - width], power[width:])
        width *= 2


def text_blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of the batch's texts as bytes, each of `limit` bytes or a single longer text; null is empty."""
    let_go()
    texts = batch.column(column).cast(pa.large_binary())
    begin, size, out = 0, 0, []
    for i in range(batch.num_rows):
        text = texts[i].as_py() or b""
        if out and size + len(text) > limit:
            yield begin, out
            begin, size, out = i, 0, []
        out.append(text)
        size += len(text)
    if out:
        yield begin, out


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return np.ascontiguousarray(hashes).view(np.int64)
