"""Intermediate tables in the shared folder, read again from there when an executor is lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.lookup import BROADCAST_BYTES, measured_bytes
from shelfwatch.session import fresh_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once and written to the shared folder."""
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """For a join: to be sent to every task if measured to be small, else shuffled like any other side."""
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df
