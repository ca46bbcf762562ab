"""Secrets in texts, and credentials whose parts are found near each other.

Strong patterns are reported as they stand. Weak parts alone say nothing: an access identifier, a bare string that
could be a secret, an endpoint. They are laid over a text as intervals, and an interval join links them: a part is
reported only if no more than the scope lies between it and a complementary part. Cells are as wide as the scope; every
part is placed in all cells it covers, looked for in these and their neighbours, and compared by the gap. So what is
joined is bounded by the width of a cell, however long a text is, and the join answers whether there is a partner rather
than spelling out pairs.

Texts are searched where they are read and never move; the parts found do.

Defined results: a null or empty text holds nothing; repeated rows have the same spans each; a null id is kept; columns
other than the id and the text are ignored. Places count code points.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved

# The strong patterns, by kind, in the order in which kinds are listed. Longest match, then the length.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

KINDS = ["assign", "access", "hex", "identifier", "bare", "endpoint"]
WEAK = ["identifier", "bare", "endpoint"]
# What completes what: a bare string needs somebody or somewhere it is good for; the others need a secret.
PARTNERS = {
    "identifier": ["assign", "hex", "bare"],
    "bare": ["access", "identifier", "endpoint"],
    "endpoint": ["assign", "access", "hex", "bare"],
}
SCOPE = 200

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4))
_HEX = re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"])
_KEYWORDS = re.compile("pass|secret|token|api_?key", re.IGNORECASE | re.ASCII)
# Weak parts: a named user or client, a mixed string as long as keys are or longer, an address with a host.
_IDENTIFIER = re.compile(r"(?:user(?:name)?|login|client_?id|account|access_?key(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?[\w.@+-]{3,}", re.I | re.A)
_BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[^A-Z\s]*[A-Z])(?=[^a-z\s]*[a-z])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"(?:https?|ftp|s3|jdbc:\w+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]{4,}|(?:host(?:name)?|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[\w.-]{4,}", re.I | re.A)
_MARKS = re.compile(r"://|user|login|client|account|access|host|endpoint|server", re.I | re.A)


def strong_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the strong patterns, each kind leftmost and without overlap."""
    spans = []
    if _KEYWORDS.search(text):
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    return spans + [(*m.span(), "hex") for m in _HEX.finditer(text)]


def weak_spans(text: str, strong: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of weak parts that no strong span overlaps."""
    spans = []
    if _MARKS.search(text):
        spans += [(*m.span(), "identifier") for m in _IDENTIFIER.finditer(text)]
        spans += [(*m.span(), "endpoint") for m in _ENDPOINT.finditer(text)]
    if spans or any(kind == "access" for _, _, kind in strong):  # a bare string is nothing without one of those
        spans += [(*m.span(), "bare") for m in _BARE.finditer(text)]
    return [s for s in spans if not any(s[0] < e and b < s[1] for b, e, _ in strong)]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
SPANS = "array<struct<start: long, end: long, kind: string>>"


def _found(batches):
    for batch in batches:
        strong, weak = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            spans = sorted(strong_spans(text), key=_order)
            strong.append([dict(zip(("start", "end", "kind"), s)) for s in spans])
            weak.append([dict(zip(("start", "end", "kind"), s)) for s in weak_spans(text, spans)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(strong, _SPANS), pa.array(weak, _SPANS)],
            ["doc_id", "row_key", "strong", "weak"],
        )


def _order(span):
    return span[0], KINDS.index(span[2])


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts of (row_key, kind, start, end) that a complementary part is near to."""
    first, last = (F.floor(F.col(c) / scope).cast("long") for c in ("start", "end"))
    needs = F.create_map(*(F.lit(x) for k, v in PARTNERS.items() for x in (k, F.array(*map(F.lit, v)))))
    weak = parts.filter(F.col("kind").isin(WEAK)).withColumn("needs", needs[F.col("kind")])
    weak = weak.withColumn("cell", F.explode(F.sequence(first - 1, last + 1))).alias("w")
    other = parts.withColumn("cell", F.explode(F.sequence(first, last))).alias("o")
    gap = F.greatest(F.col("w.start") - F.col("o.end"), F.col("o.start") - F.col("w.end"))
    near = (
        (F.col("w.row_key") == F.col("o.row_key")) & (F.col("w.cell") == F.col("o.cell"))
        & (gap <= scope) & F.array_contains("w.needs", F.col("o.kind"))
    )
    # A part is in several cells and may be near a partner in each.
    return weak.join(other, near, "left_semi").select("row_key", "kind", "start", "end").distinct()


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: doc_id, strong and all (arrays of start, end, kind, by start and then kind as listed)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    # Written, so that texts are searched once for the spans and the parts.
    found = saved(docs.mapInArrow(_found, f"doc_id long, row_key long, strong {SPANS}, weak {SPANS}"), "spans")
    parts = found.filter(F.size("weak") > 0).select("row_key", F.explode(F.concat("strong", "weak")).alias("s")).select("row_key", "s.*")
    weak = linked(parts.distinct(), scope).groupBy("row_key").agg(F.collect_list(F.struct("start", "end", "kind")).alias("added"))
    place = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    ranked = lambda s: F.struct(s.start.alias("start"), place[s.kind].alias("place"), s.end.alias("end"), s.kind.alias("kind"))
    both = F.concat("strong", F.coalesce("added", F.array().cast(SPANS)))
    ordered = F.transform(F.array_sort(F.transform(both, ranked)), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")))
    return found.drop("weak").join(weak, "row_key", "left").select("doc_id", "strong", ordered.alias("all"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and written spans of `secret_spans`."""
    count = lambda kind: F.size(F.filter("strong", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(_written(F.col("strong")), 256).alias("base_sha256"), _written(F.col("all")).alias("spans"),
    )
