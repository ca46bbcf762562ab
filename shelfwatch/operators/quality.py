"""Checks of what the tables promise; every check is one pass with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.functions.casts import convert
from shelfwatch.sources.schemas import ENTITY, FACT_WIDTHS


def _per_column(df: DataFrame, tests: dict[str, Column], measure: str) -> DataFrame:
    """Count each test over the frame, as one row per column."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(t).alias(c) for c, t in tests.items()])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(measure)) for c in tests]
    )
    return counts.select(F.col("_rows").alias("n_rows"), F.inline(pairs)).select(
        "column_name", "n_rows", measure
    )


def cast_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Values that are present but cannot be converted to the column's type."""
    tests = {
        c: F.col(c).isNotNull() & convert(F.col(c), t).isNull()
        for c, t in types.items()
        if c in df.columns
    }
    return _per_column(df, tests, "n_failures")


def too_long(df: DataFrame, widths: dict[str, int] = FACT_WIDTHS) -> DataFrame:
    """Texts longer than the width declared for the column."""
    tests = {c: F.length(c) > n for c, n in widths.items() if c in df.columns}
    return _per_column(df, tests, "n_too_long")


def unmatched_dimensions(joined: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Rows whose lookup found nothing, per dimension."""
    return _per_column(joined, tests, "n_unmatched").withColumnRenamed("column_name", "dimension")


def history_violations(history: DataFrame) -> DataFrame:
    """Entities or versions that break the history's rules; all counts are 0 on a sound history."""
    line = Window.partitionBy(*ENTITY).orderBy("StartDate", F.col("EndDate").asc_nulls_last())
    checked = history.withColumn("_next", F.lead("StartDate").over(line))
    per_entity = checked.groupBy(*ENTITY).agg(
        F.count("*").alias("versions"),
        F.count_if(F.col("IsActive") == 1).alias("active"),
        F.count_if(F.col("EndDate").isNull() != (F.col("IsActive") == 1)).alias("open_mismatch"),
        F.count_if(F.col("EndDate") <= F.col("StartDate")).alias("empty"),
        F.count_if(
            F.col("_next").isNotNull()
            & (F.col("EndDate").isNull() | (F.col("_next") < F.col("EndDate")))
        ).alias("overlaps"),
    )
    return per_entity.agg(
        F.count("*").alias("n_entities"),
        F.coalesce(F.sum("versions"), F.lit(0)).alias("n_versions"),
        F.count_if(F.col("active") != 1).alias("n_not_one_active"),
        F.coalesce(F.sum("open_mismatch"), F.lit(0)).alias("n_open_mismatch"),
        F.coalesce(F.sum("empty"), F.lit(0)).alias("n_empty_interval"),
        F.coalesce(F.sum("overlaps"), F.lit(0)).alias("n_overlaps"),
    )


def batch_metrics(prices: DataFrame) -> DataFrame:
    """Row and file counts of a batch, and the time span it covers."""
    return prices.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("file_name").alias("n_files"),
        F.min("file_date").alias("first_date"),
        F.max("file_date").alias("last_date"),
    )


def fail_above(counts: DataFrame, column: str, threshold: int) -> None:
    """Stop the run when any count of a (small) check result exceeds the threshold."""
    worst = counts.agg(F.max(column)).first()[0]
    if worst is not None and worst > threshold:
        raise ValueError(f"{column} is {worst}, allowed are {threshold}")
