"""Left lookup into a dimension: broadcast when measured small, else a shuffle join with measured hot keys salted."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
# Keys the sketch of hot ones keeps, and the most it tells.
TRACKED = 100_000
MOST_HOT = 10_000


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the rows' size in memory, from one aggregate over the frame itself."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 24 for c in df.columns]
    return df.select(reduce(add, widths).alias("w")).agg(F.sum("w")).first()[0] or 0


def hot_keys(facts: DataFrame, on: list[str]) -> list[int]:
    """Hashes of the keys that hold more rows than a shuffle partition's fair share, by a sketch over one pass.

    There can be no more of them than partitions. The sketch tracks ``TRACKED`` keys and may count a
    key too high, never one that hot too low to be listed; a key named in vain is salted in vain.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64(*on)
    top = facts.agg(F.call_function("approx_top_k", key, F.lit(min(partitions, MOST_HOT)), F.lit(TRACKED)).alias("top"), F.count("*").alias("n")).first()
    return [t["item"] for t in top.top or [] if t["count"] * partitions > top.n]


def attach(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    spread: list[str],
    max_bytes: int | None = None,
    derived_from: DataFrame | None = None,
) -> DataFrame:
    """Left join ``facts`` to ``dim`` on equal-named keys.

    A dimension is broadcast only after its size was measured. Beyond the bound, the rows of a hot
    key (a chain may hold a third of all prices) are spread over all join partitions: the salt is a
    hash of the ``spread`` columns, so a re-run task repeats it. Which keys are hot is measured, and
    only their dimension rows are repeated, once per salt; all other rows have one salt. Each fact
    row meets each of its dimension rows exactly once either way.

    ``derived_from`` is a frame the dimension was picked from, with rows at least as many and as
    wide: if it is small, the dimension is, and need not be computed to be measured.
    """
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    size = measured_bytes(dim if derived_from is None else derived_from)
    if size > max_bytes and derived_from is not None:
        size = measured_bytes(dim)
    if size <= max_bytes:
        return facts.join(F.broadcast(dim), on, "left")
    hot = hot_keys(facts, on)
    if not hot:
        return facts.join(dim, on, "left")
    salts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.xxhash64(*on).isin(hot)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0)
    each = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = dim.withColumn("_salt", F.explode(each))
    return facts.withColumn("_salt", salt).join(repeated, [*on, "_salt"], "left").drop("_salt")
