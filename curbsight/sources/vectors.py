"""Persisted document vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_vectors(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Vectors written by :func:`write_vectors`; a missing path raises."""
    return spark.read.parquet(path)
