"""Attributes of anchor tags, as built-in string expressions over the whole page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANCHOR = r"(?is)<a\s[^>]*>"

# Character references that occur in attribute values, '&amp;' last (fixed values).
_REFERENCES = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def anchors(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, in double or single quotes; null when the tag does not carry it."""
    pattern = rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*')"
    quoted = F.regexp_extract(tag, pattern, 1)
    value = F.when(F.length(quoted) > 0, quoted.substr(F.lit(2), F.length(quoted) - 2))
    for reference, char in _REFERENCES:
        value = F.replace(value, F.lit(reference), F.lit(char))
    return value


def has_class(tag: Column, css_class: str) -> Column:
    words = F.split(F.coalesce(attribute(tag, "class"), F.lit("")), r"\s+")
    return F.array_contains(words, css_class)
