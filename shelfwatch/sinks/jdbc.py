"""Relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

DRIVER = "org.postgresql.Driver"


def append_table(df: DataFrame, url: str, table: str, user: str, password: str, batch: int = 10_000) -> None:
    """Append rows; each task writes its partition over its own connection."""
    df.write.jdbc(
        url,
        table,
        mode="append",
        properties={"user": user, "password": password, "driver": DRIVER, "batchsize": str(batch)},
    )


def replace_table(df: DataFrame, url: str, table: str, user: str, password: str) -> None:
    """Full replace that keeps the table's definition. ``df`` must not read the same table."""
    df.write.option("truncate", "true").jdbc(
        url, table, mode="overwrite", properties={"user": user, "password": password, "driver": DRIVER}
    )
