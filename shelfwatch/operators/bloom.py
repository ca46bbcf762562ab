"""Filters that tell which names are surely not in a set, as tables of bit blocks made of built-in functions.

A name sets ``PROBES`` bits of one block of 256, so asking for it is one lookup by block number, however
large the set is; a block is four longs. Nothing that is in the set is ever ruled out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators import lookup

BLOCK_BITS = 256
BITS_PER_NAME = 14
PROBES = 6
ROW_BYTES = 96
WORDS = [f"_bits{k}" for k in range(BLOCK_BITS // 64)]


def blocks_for(names: int) -> int:
    """How many blocks a set of so many names is given; a power of two, so that growing sets keep a filter for long."""
    wanted = -(-max(names, 1) * BITS_PER_NAME // BLOCK_BITS)
    return 1 << (wanted - 1).bit_length()


def _block(name: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(name, F.lit(1)), F.lit(blocks))


def _places(hash_: Column) -> list[Column]:
    """The places of a name's bits within its block."""
    return [F.shiftrightunsigned(hash_, 8 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(PROBES)]


def _words(name: Column) -> list[Column]:
    """The bits of a name, as the words of its block."""
    places = _places(F.xxhash64(name, F.lit(2)))
    out = []
    for word in range(len(WORDS)):
        bits = F.lit(0).cast("long")
        for place in places:
            inside = F.floor(place / 64) == word
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
            bits = bits.bitwiseOR(F.when(inside, bit).otherwise(F.lit(0).cast("long")))
        out.append(bits)
    return out


def filter_of(names: DataFrame, column: str, blocks: int) -> DataFrame:
    """(_block, words): the filter of the names; blocks without any name are left out."""
    marked = names.filter(F.col(column).isNotNull()).select(
        _block(F.col(column), blocks).alias("_block"), *[w.alias(n) for n, w in zip(WORDS, _words(F.col(column)))]
    )
    return merged(marked)


def merged(filters: DataFrame) -> DataFrame:
    """One filter of several of the same number of blocks."""
    return filters.groupBy("_block").agg(*[F.bit_or(n).alias(n) for n in WORDS])


def split(rows: DataFrame, column: str, filter_: DataFrame, blocks: int) -> DataFrame:
    """The rows with ``maybe``: false if the name is surely not in the filter's set."""
    # A filter has no more rows than blocks, of five longs each.
    filter_ = F.broadcast(filter_) if blocks * ROW_BYTES <= lookup.BROADCAST_BYTES else filter_
    # The hash is a column below the join, and a bit is looked up by its place, so the condition stays short: with the
    # words of the name built in it, its code is too long for the JVM to compile and takes 30 microseconds a row.
    name = F.col(column)
    asked = rows.withColumns({"_block": _block(name, blocks), "_hash": F.xxhash64(name, F.lit(2))}).join(filter_, "_block", "left")
    every = F.col(WORDS[0]).isNotNull()
    for place in _places(F.col("_hash")):
        word = F.get(F.array(*WORDS), F.shiftright(place, 6).cast("int"))
        every = every & (F.call_function("getbit", word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return asked.withColumn("maybe", F.coalesce(every, F.lit(False))).drop("_block", "_hash", *WORDS)
