"""Catalog tables: write, read, list and describe."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Overwrite a table, its schema included. ``path`` keeps the files outside the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def run_query(spark: SparkSession, query: str) -> DataFrame:
    """Run a SQL text over the registered tables and views; a failure raises."""
    return spark.sql(query)


def list_tables(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """Tables in the current schema, temporary views left out."""
    found = spark.sql("SHOW TABLES").where(~F.col("isTemporary"))
    if names is not None:
        found = found.where(F.col("tableName").isin([n.lower() for n in names]))
    return found.select(F.col("tableName").alias("table_name"))


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One line per table with its row count."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def mapping_table(spark: SparkSession, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A mapping as a two-column table of known, small size."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return spark.range(0, 1, 1, 1).select(F.explode(entries).alias(key, value))
