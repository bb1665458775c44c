"""Checks on loaded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, in one pass."""
    return df.select([F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("property_id",)) -> DataFrame:
    """Keys that occur more than once; a sound gold table gives no rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("records")).where(F.col("records") > 1)


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def column_report(df: DataFrame, description: DataFrame) -> DataFrame:
    """Column names and types of a table with the count of values in each column."""
    counts = df.select([F.count(F.col(c)).alias(c) for c in df.columns])
    values = counts.unpivot([], list(df.columns), "col_name", "value_count")
    return description.join(values, "col_name")
