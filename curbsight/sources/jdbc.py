"""Relational database source and sink over Spark's JDBC connector.

Host, user and password come from the caller or from the environment; there
is no default host and nothing secret in the code.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

LIVENESS_QUERY = "SELECT 1 AS test"
TABLE_LIST = "INFORMATION_SCHEMA.TABLES"


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    login_timeout_seconds: int = 30

    @classmethod
    def from_environment(cls, prefix: str = "CURBSIGHT_JDBC_", env: Mapping[str, str] | None = None) -> JdbcTarget:
        env = os.environ if env is None else env
        if f"{prefix}URL" not in env:
            raise ValueError(f"{prefix}URL is not set")
        return cls(
            url=env[f"{prefix}URL"],
            user=env.get(f"{prefix}USER"),
            password=env.get(f"{prefix}PASSWORD"),
            driver=env.get(f"{prefix}DRIVER"),
        )

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "loginTimeout": str(self.login_timeout_seconds),
        }
        return {k: v for k, v in given.items() if v is not None}


def read_query(spark: SparkSession, target: JdbcTarget, query: str) -> DataFrame:
    """The result of a query that the database runs."""
    return spark.read.format("jdbc").options(**target.options()).option("dbtable", f"({query}) t").load()


def read_relation(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A table or catalog view. With a partition column the read is split into parallel ranges;
    rows outside the bounds still arrive, in the first and last range."""
    reader = spark.read.format("jdbc").options(**target.options()).option("dbtable", table)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def is_alive(spark: SparkSession, target: JdbcTarget) -> bool:
    """Whether the database answers; connection errors are raised, not swallowed."""
    return read_query(spark, target, LIVENESS_QUERY).head() is not None


def write_relation(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    connections: int = 8,
    batch_rows: int = 10_000,
    keep_definition: bool = False,
) -> None:
    """Overwrite a table over at most ``connections`` parallel sessions.

    ``keep_definition`` empties the table instead of dropping it, which keeps
    its indexes and grants.
    """
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(**target.options())
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .option("truncate", keep_definition)
        .save()
    )


def publish(tables: Mapping[str, DataFrame], target: JdbcTarget, **options) -> None:
    """Overwrite several tables, one after the other."""
    for name, df in tables.items():
        write_relation(df, target, name, **options)


def list_relations(spark: SparkSession, target: JdbcTarget, catalog_view: str = TABLE_LIST) -> DataFrame:
    return read_relation(spark, target, catalog_view)
