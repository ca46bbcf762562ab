"""Documents of flat items, parsed by columns.

A document is plain if it is well-formed UTF-8 of one root, and its items hold nothing but elements that hold nothing but
text: no attributes, comments, sections, prefixes or doctype, no second element of a declared tag in an item, no number that
is written in a rare way. What is plain is decided by the document alone, before any of its items is used. Such documents
are taken apart by arrays of tags and texts, a few million bytes at a time; all others are for Spark's reader, and both
give the same rows.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import compute

try:
    import numpy as np
except ModuleNotFoundError:  # no document is plain then
    np = None

PIECE = 4 << 20
MOST_TAGS = 1000
LONGEST = 64 * PIECE

_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
_TAG = re.compile(rf"(/?)({_NAME})\s*(/?)", re.ASCII)
_ATTRIBUTE = rf"""\s+({_NAME})\s*=\s*(?:"[^"&]*"|'[^'&]*')"""
_WITH_ATTRIBUTES = re.compile(rf"({_NAME})((?:{_ATTRIBUTE})+)\s*(/?)", re.ASCII)
_DECLARATION = re.compile(r"""\?xml\s+version="1\.0"(\s+encoding="utf-8")?(\s+standalone="(yes|no)")?\s*\?""", re.ASCII | re.IGNORECASE)
_ENTITY = re.compile(r"&(?:(amp|lt|gt|quot|apos)|#([0-9]{1,7})|#x([0-9A-Fa-f]{1,6}));?")
_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_SIMPLE_NUMBER = r"^-?[0-9]{1,18}$|^-?[0-9]{1,17}\.[0-9]{1,17}$"
_NUMBER = r"^[+-]?(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)([eE][+-]?\p{Nd}+)?$"
_BLANK = " \t\n"


class Fault(ValueError):
    """Why bytes are not one whole gzip file, or several in a row."""


class NotPlain(ValueError):
    pass


def unpacked(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The content of gzip files in a row, by blocks of bounded size."""
    unpack, begun = None, False
    while block := stream.read(size):
        while block:
            unpack = unpack or zlib.decompressobj(31)
            try:
                data = unpack.decompress(block, PIECE)
            except zlib.error as error:
                raise Fault("not_gzip") from error
            begun = True
            if data:
                yield data
            if unpack.eof:
                block, unpack = unpack.unused_data, None
            else:
                block = unpack.unconsumed_tail
                if not block and len(data) == PIECE:  # more may be inside than was given out
                    while data := unpack.decompress(b"", PIECE):
                        yield data
    if unpack is not None:
        raise Fault("truncated")
    if not begun:
        raise Fault("empty")


def _pieces(blocks: Iterator[bytes], row_tag: str) -> Iterator[bytes]:
    """The content cut behind items."""
    end, held, size = f"</{row_tag}>".encode(), [], 0
    for block in blocks:
        held.append(block)
        size += len(block)
        if size >= PIECE:
            data = b"".join(held)
            cut = data.rfind(end)
            if cut >= 0:
                yield data[: cut + len(end)]
                data = data[cut + len(end) :]
            if len(data) > LONGEST:
                raise NotPlain("item too long")
            held, size = [data], len(data) if cut >= 0 else 0
    yield b"".join(held)


def _lines(data: bytes) -> bytes:
    """The ends of lines as XML has them."""
    return data.replace(b"\r\n", b"\n").replace(b"\r", b"\n") if b"\r" in data else data


def _character(found: re.Match) -> str:
    if not found[0].endswith(";"):
        raise NotPlain("entity")
    if found[1]:
        return _ENTITIES[found[1]]
    code = int(found[2]) if found[2] else int(found[3], 16)
    if not (code in (9, 10, 13) or 0x20 <= code < 0xD800 or 0xE000 <= code < 0xFFFE or 0x10000 <= code < 0x110000):
        raise NotPlain("character")
    return chr(code)


def _unescaped(text: str) -> str:
    if text.count("&") != len(_ENTITY.findall(text)):
        raise NotPlain("entity")
    return _ENTITY.sub(_character, text)


class _Tags:
    """What the distinct tags of a piece are."""

    def __init__(self, tags: list[str], row_tag: str, first: bool):
        if len(tags) > MOST_TAGS:
            raise NotPlain("tags")
        self.names, ids = [], {}
        n = len(tags)
        self.name, self.opens, self.closes, self.empty, self.item = np.full(n, -1), *(np.zeros(n, bool) for _ in range(4))
        self.inner = np.zeros(n, bool)  # may stand inside an item
        for i, tag in enumerate(tags):
            if found := _TAG.fullmatch(tag):
                name, inner = found[2], True
                self.closes[i], self.empty[i] = found[1] == "/", found[3] == "/"
                if self.closes[i] and self.empty[i]:
                    raise NotPlain("tag")
            elif found := _WITH_ATTRIBUTES.fullmatch(tag):
                name, inner = found[1], False
                self.empty[i] = found[4] == "/"
                attributes = re.findall(_ATTRIBUTE, found[2], re.ASCII)
                if len(set(attributes)) < len(attributes) or any(a.lower().startswith("xml") for a in attributes):
                    raise NotPlain("attributes")
            elif first and _DECLARATION.fullmatch(tag):
                continue
            else:
                raise NotPlain("tag")
            self.opens[i] = not self.closes[i] and not self.empty[i]
            if name.lower() == row_tag.lower():
                if name != row_tag or not inner or self.empty[i]:
                    raise NotPlain("row tag")
                self.item[i] = True
            if name.lower().startswith("xml"):
                raise NotPlain("reserved name")
            self.inner[i] = inner
            self.name[i] = ids.setdefault(name, len(self.names))
            if self.name[i] == len(self.names):
                self.names.append(name)


class Piece:
    """Items of a part of a document; ``outside`` are the elements open around them and is continued."""

    def __init__(self, data: bytes, row_tag: str, outside: list[str], first: bool):
        data = _lines(data)
        if b"]]>" in data or b"\xef\xbf\xbe" in data or b"\xef\xbf\xbf" in data:
            raise NotPlain("character")
        bytes_ = np.frombuffer(data, np.uint8)
        if np.count_nonzero(bytes_ < 32) != data.count(b"\n") + data.count(b"\t"):
            raise NotPlain("character")
        try:
            data.decode()
        except UnicodeDecodeError as error:
            raise NotPlain("encoding") from error
        self.n, self.at = 0, np.empty(0, np.int64)
        signs = np.flatnonzero((bytes_ & 0xFD) == ord("<"))  # "<" and ">"
        is_begin = bytes_[signs] == ord("<")
        begins = signs[is_begin]
        before = data[: begins[0]] if len(begins) else data
        if outside in ([], [""]) and before.strip(_BLANK.encode()):
            raise NotPlain("text outside")
        if not len(begins):
            return
        if len(data) > LONGEST or (before and data[begins[0] + 1] == ord("?")):
            raise NotPlain("item too long, or no begin")
        at = np.flatnonzero(is_begin) + 1
        if at[-1] >= len(signs) or is_begin[at].any():
            raise NotPlain("tag")
        ends = signs[at]
        offsets = np.empty(4 * len(begins) + 1, np.int32)
        offsets[0:-1:4], offsets[1::4], offsets[2::4] = begins + 1, ends, ends + 1
        offsets[3::4], offsets[-1] = np.append(begins[1:], len(data)), len(data)
        # Tag, ">", text, "<", and so on: all of them where they stand.
        self.parts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
        self.lengths = offsets[3::4] - offsets[2::4]
        coded = self.parts.take(pa.array(np.arange(0, 4 * len(begins), 4))).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        spellings = coded.dictionary.to_pylist()
        tags = _Tags(spellings, row_tag, first)
        item = tags.item[code]
        begin_item, end_item = item & tags.opens[code], item & tags.closes[code]
        level = np.cumsum(begin_item.astype(np.int32) - end_item)
        if level.min() < 0 or level.max() > 1 or level[-1]:
            raise NotPlain("items")
        self._outside(np.flatnonzero((level == 0) & ~end_item), np.flatnonzero(begin_item), code, spellings, tags, outside)
        self.n = int(begin_item.sum())
        self.at = begins[begin_item]
        inside = (level == 1) & ~begin_item
        child = np.flatnonzero(inside & ~tags.closes[code])
        if not tags.inner[code[inside]].all():
            raise NotPlain("attributes")
        empty = tags.empty[code[child]]
        ended = child[~empty] + 1
        if np.count_nonzero(inside & tags.closes[code]) != len(ended) or not (
            (level[ended] == 1) & tags.closes[code[ended]] & (tags.name[code[child[~empty]]] == tags.name[code[ended]])
        ).all():
            raise NotPlain("nested")
        blank = np.flatnonzero((level == 1) & (self.lengths > 0) & (begin_item | tags.closes[code] | tags.empty[code]))
        if len(blank) and compute.sum(compute.binary_length(compute.ascii_trim(self._texts(blank), _BLANK))).as_py():
            raise NotPlain("text")
        self.child, self.names = child, tags.names
        self.length = np.where(empty, 0, self.lengths[child])
        self.name = tags.name[code[child]]
        self.of = (np.cumsum(begin_item) - 1)[child]
        self.escaped = b"&" in data
        if self.escaped:
            self._check_entities(data)
        if {n.lower() for n in self.names} & {"_corrupt_record", "xs_any"}:
            raise NotPlain("reserved name")

    def _outside(self, where, items, code, spellings, tags, outside) -> None:
        if len(where) > 10 * MOST_TAGS:
            raise NotPlain("elements outside")
        opened_at, closed_at = (0 if outside[1:] else len(code)), len(code)
        for i in where:
            c = code[i]
            if tags.name[c] < 0:  # the declaration
                if i or outside:
                    raise NotPlain("declaration")
                continue
            name = tags.names[tags.name[c]]
            if outside == [""]:
                raise NotPlain("second root")
            if tags.closes[c]:
                if not outside[1:] or outside.pop() != name:
                    raise NotPlain("not closed")
                if not outside[1:]:
                    outside[:] = [""]  # the root has ended
                    closed_at = i
                    if len(compute.ascii_trim(self._texts(np.arange(i, i + 1)), _BLANK)[0].as_py()):
                        raise NotPlain("text outside")
            elif tags.opens[c]:
                if not outside:
                    outside.append("root")
                    opened_at = i
                outside.append(name)
            elif not outside:
                raise NotPlain("empty root")
        if len(items) and (items[0] < opened_at or items[-1] > closed_at):
            raise NotPlain("items outside")

    def _check_entities(self, data: bytes) -> None:
        text = data.decode()
        if text.count("&") != len(_ENTITY.findall(text)):
            raise NotPlain("entity")
        for found in set(m[0] for m in _ENTITY.finditer(text)):
            _ENTITY.sub(_character, found)

    def _texts(self, at: np.ndarray) -> pa.Array:
        return self.parts.take(pa.array(4 * at + 2))

    def _unescape(self, texts: pa.Array) -> pa.Array:
        if self.escaped:
            mask = compute.fill_null(compute.match_substring(texts, "&"), False)
            if (some := texts.filter(mask).to_pylist()):
                texts = compute.replace_with_mask(texts, mask, pa.array([_unescaped(t) for t in some], pa.string()))
        return texts

    def _places(self, declared: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Which declared tag each element is of, less than zero: none; and the place its text has, column by column."""
        places = {t.lower(): i for i, t in enumerate(declared)}
        column = np.array([places.get(n.lower(), -1) for n in self.names] or [-1])[self.name]
        place = column * self.n + self.of
        taken = np.zeros(len(declared) * self.n, bool)
        taken[place[column >= 0]] = True
        if np.count_nonzero(taken) < np.count_nonzero(column >= 0):
            raise NotPlain("declared twice")
        return column, place

    def columns(self, declared: list[str]) -> tuple[list[pa.Array], np.ndarray]:
        """A text per item for each declared tag, in any letter case, and how many elements are of no such tag."""
        if not self.n:
            return [pa.array([], pa.string())] * len(declared), np.zeros(0, np.int32)
        column, place = self._places(declared)
        filled = (column >= 0) & (self.length > 0)
        at, none = np.zeros(len(declared) * self.n, np.int64), np.ones(len(declared) * self.n, bool)
        at[place[filled]], none[place[filled]] = 4 * self.child[filled] + 2, False
        texts = self._unescape(self.parts.take(pa.array(at, mask=none)))
        found = [texts.slice(i * self.n, self.n) for i in range(len(declared))]
        return found, np.bincount(self.of[column < 0], minlength=self.n).astype(np.int32)

    def has_others(self, declared: list[str]) -> bool:
        """Whether any tag is not declared; raises what ``columns`` would raise."""
        return bool(self.n) and bool((self._places(declared)[0] < 0).any())

    def check_variants(self) -> None:
        """Raises what ``variants`` would raise."""
        if self.n:
            self._runs()
            self._numbers(self._trimmed().unique())

    def _runs(self) -> np.ndarray:
        """Which elements are not of the same tag, in any letter case, as the one before in their item."""
        folded = {}
        fold = np.array([folded.setdefault(n.lower(), i) for i, n in enumerate(self.names)] or [0])[self.name]
        first = np.ones(len(self.child), bool)
        first[1:] = (self.of[1:] != self.of[:-1]) | (fold[1:] != fold[:-1])
        seen = np.zeros(self.n * len(self.names), bool)
        seen[(self.of * len(self.names) + fold)[first]] = True
        if np.count_nonzero(seen) < np.count_nonzero(first):
            raise NotPlain("tags in turns")
        return first

    def variants(self) -> tuple[pa.Array, pa.Array]:
        """Every item as JSON, of which Spark makes the variant that its reader makes of the item, and its tags."""
        if not self.n:
            return pa.array([], pa.string()), pa.array([], pa.string())
        first = self._runs()  # elements of a tag that follow each other are one array
        values = self._json(self._trimmed())
        begins = np.append(np.flatnonzero(first), len(self.child)).astype(np.int32)
        if len(begins) - 1 < len(self.child):
            many = pa.array(np.diff(begins) > 1)
            joined = compute.binary_join(pa.ListArray.from_arrays(pa.array(begins), values), ",")
            values = compute.if_else(many, compute.binary_join_element_wise("[", joined, "]", ""), joined)
        name = pa.array(self.name[first])
        keys = pa.array([json.dumps(n) + ":" for n in self.names] or [""], pa.string()).take(name)
        members = compute.binary_join_element_wise(keys, values, "")
        by_item = np.append(0, np.cumsum(np.bincount(self.of[first], minlength=self.n))).astype(np.int32)
        whole = compute.binary_join(pa.ListArray.from_arrays(pa.array(by_item), members), ",")
        text = compute.binary_join_element_wise("{", whole, "}", "")
        text = compute.if_else(pa.array(np.diff(by_item) > 0), text, "null")
        tags = pa.ListArray.from_arrays(pa.array(by_item), pa.array(self.names or [""], pa.string()).take(name))
        return text, compute.binary_join(tags, " ")

    def _trimmed(self) -> pa.Array:
        texts = self.parts.take(pa.array(np.where(self.length > 0, 4 * self.child + 2, 0), mask=self.length == 0))
        return compute.utf8_trim(self._unescape(compute.fill_null(texts, "")), "".join(map(chr, range(33))))

    def _numbers(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Which texts are numbers, and the texts that are not."""
        simple = compute.match_substring_regex(texts, _SIMPLE_NUMBER)
        rest = texts.filter(compute.invert(simple))
        if compute.any(compute.match_substring_regex(compute.replace_substring(rest, ",", ""), _NUMBER)).as_py():
            raise NotPlain("number")
        return simple, rest

    def _json(self, texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        texts = coded.dictionary
        simple, rest = self._numbers(texts)
        lower = compute.utf8_lower(rest)
        truth = compute.is_in(lower, pa.array(["true", "false"]))
        for sign, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
            rest = compute.replace_substring(rest, sign, written)
        quoted = compute.if_else(truth, lower, compute.binary_join_element_wise('"', rest, '"', ""))
        quoted = compute.if_else(compute.equal(lower, ""), "null", quoted)
        numbers = compute.replace_substring_regex(texts, "^(-?)0+([0-9])", "\\1\\2")
        return compute.replace_with_mask(numbers, compute.invert(simple), quoted).take(coded.indices)


def items(streams: Iterator, row_tag: str) -> Iterator[tuple[Piece, np.ndarray]]:
    """The items of packed documents that are plain, piece by piece, and how many of a piece are of which document.

    Small documents are put together, as the work of a piece is a matter of arrays more than of items.
    """
    held, size = [], 0
    for number, stream in enumerate(streams):
        with stream:
            pieces = _pieces(unpacked(stream), row_tag)
            data, more = next(pieces).removeprefix(b"\xef\xbb\xbf"), next(pieces, None)
            if more is None:
                held.append((number, _PROLOG.sub(b"", _lines(data), count=1)))
                size += len(data)
            else:
                outside = []
                for i, part in enumerate(itertools.chain([data, more], pieces)):
                    piece = Piece(part, row_tag, outside, not i)
                    yield piece, np.full(piece.n, number)
        if size >= PIECE // 2:
            yield _together(held, row_tag)
            held, size = [], 0
    if held:
        yield _together(held, row_tag)


_PROLOG = re.compile(rb"^<\?xml[^<>]*>")


def _together(documents: list[tuple[int, bytes]], row_tag: str) -> tuple[Piece, np.ndarray]:
    piece = Piece(b"".join([b"<all>", *[data for _, data in documents], b"</all>"]), row_tag, [], True)
    ends = np.cumsum([len(data) for _, data in documents]) + len("<all>")
    of = np.searchsorted(ends, piece.at, "right")
    return piece, np.array([number for number, _ in documents])[of]


def inspect(stream, row_tag: str, declared: list[str]) -> tuple[str | None, bool]:
    """Why the bytes are no whole gzip file, null if they are; and whether they are a plain document."""
    outside, held, n = [], None, 0
    blocks = unpacked(stream)
    try:
        try:
            if np is None:
                raise NotPlain("no numpy")
            for data in _pieces(blocks, row_tag):
                piece = Piece(data.removeprefix(b"\xef\xbb\xbf") if not n else data, row_tag, outside, not n)
                n += 1
                # Variants are made of all items of a document or of none, so only one that is seen whole is spared this.
                if not piece.has_others(declared) and n == 1:
                    held = piece
                    continue
                if held:
                    held.check_variants()
                    held = None
                piece.check_variants()
            return None, outside == [""]
        except NotPlain:
            for _ in blocks:
                pass
            return None, False
    except Fault as error:
        return str(error), False
