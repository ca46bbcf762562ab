"""Text to typed columns; what cannot be converted becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.sources.schemas import PRICE

# Only texts of the right form reach a cast: a failing cast raises and catches an exception per
# row, some fifty times the cost of the pattern test.
_WHOLE = r"^\s*[+-]?\d+(\.\d*)?\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Texts of the two truth values (fixed values).
_TRUE = ["t", "true", "y", "yes", "1"]
_FALSE = ["f", "false", "n", "no", "0"]


def to_whole(text: Column, type_name: str) -> Column:
    """Integral cast that cuts off a fraction ('12.5' -> 12)."""
    return F.when(text.rlike(_WHOLE), F.substring_index(text, ".", 1)).try_cast(type_name)


def to_price(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text).try_cast(PRICE)


def to_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*_TRUE), True).when(word.isin(*_FALSE), False)


def convert(text: Column, type_name: str) -> Column:
    if type_name in ("bigint", "int"):
        return to_whole(text, type_name)
    if type_name == "price":
        return to_price(text)
    if type_name == "boolean":
        return to_boolean(text)
    return text.try_cast(type_name)


def convert_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed projection: convert the listed columns in place, keep the others and those that have the type."""
    have = dict(df.dtypes)
    wrong = {c: t for c, t in types.items() if c in have and have[c] != (PRICE.simpleString() if t == "price" else t)}
    return df.withColumns({c: convert(F.col(c), t) for c, t in wrong.items()})
