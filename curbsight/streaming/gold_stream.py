"""Gold tables kept up to date batch by batch.

The base aggregate of tickets is a mergeable state: counts and sums add up,
maxima take the greater. A batch of new tickets is aggregated by itself and
merged with the state of the batches before it, so old tickets are never read
again. The state after a batch has a folder of its own, named by the batch;
a batch that is replayed starts from the state before it and writes the same
folder again, so it counts once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.operators import gold, silver
from curbsight.sources.storage import _file_system

GREATEST = ("missed_pickups", "renewal_date")


def merge(states: DataFrame) -> DataFrame:
    """Rows of the base aggregate, several per key, as one per key."""
    measures = [c for c in states.columns if c not in gold.HEALTH_KEYS]
    return states.groupBy(*gold.HEALTH_KEYS).agg(*((F.max if c in GREATEST else F.sum)(c).alias(c) for c in measures))


def apply_batch(silver: DataFrame, batch_id: int, root: str) -> None:
    """Merge the silver tickets of a batch into the state; for ``foreachBatch``. Batch ids rise."""
    spark = silver.sparkSession
    fresh = gold.base_aggregate(silver)
    before = [b for b in batches(spark, root) if b < batch_id]
    if before:
        fresh = merge(spark.read.parquet(_folder(root, before[-1])).unionByName(fresh))
    fresh.write.mode("overwrite").parquet(_folder(root, batch_id))


def update_gold(tickets: DataFrame, as_of: dt.date, root: str, progress: str) -> None:
    """Merge all new tickets of a stream, batch by batch, and stop. ``root`` and ``progress`` are shared folders that belong together."""
    query = (
        silver.to_silver(tickets, as_of)
        .writeStream.foreachBatch(lambda batch, batch_id: apply_batch(batch, batch_id, root))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batches(spark: SparkSession, root: str) -> list[int]:
    """Batches whose state was written to the end, in order."""
    files, path = _file_system(spark, root), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not files.exists(path(root)):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path(root))]
    done = [n for n in names if n.startswith("batch-") and files.exists(path(f"{root}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("batch-")) for n in done)


def state(spark: SparkSession, root: str) -> DataFrame:
    """The state after the last batch."""
    done = batches(spark, root)
    if not done:
        raise ValueError(f"no batch has been merged under {root}")
    return spark.read.parquet(_folder(root, done[-1]))


def gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The three gold tables as of the last batch."""
    base = state(spark, root)
    return {
        "gold_property_health": gold.health_from_base(base),
        "gold_churn_risk": gold.churn_from_base(base),
        "gold_service_performance": gold.service_from_base(base),
    }


def forget(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete the states of all but the last ``keep`` batches; a batch can be replayed if the one before it is kept."""
    files, path = _file_system(spark, root), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for batch_id in batches(spark, root)[: -max(1, keep)]:
        files.delete(path(_folder(root, batch_id)), True)


def _folder(root: str, batch_id: int) -> str:
    return f"{root}/batch-{batch_id:012d}"
