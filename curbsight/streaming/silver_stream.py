"""The silver step over ticket files as they arrive.

Silver is row by row, so the stream keeps no state and needs no watermark:
every run picks up the files that are new since the last one. The gold tables
are recomputed from the silver table afterwards.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbsight.operators import silver


def read_ticket_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    adapt: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int = 1000,
) -> DataFrame:
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return adapt(raw)


def append_silver(tickets: DataFrame, as_of: dt.date, path: str, progress: str) -> None:
    """Append the silver rows of all new files and stop. ``progress`` holds the stream's
    position; both folders must be shared by all executors."""
    query = (
        silver.to_silver(tickets, as_of)
        .writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
