"""Tables published as versions, with a switch at the end.

Every publication writes a new folder and only then points the table's view at
it. Readers see the old rows or the new ones, never a mix; a frame opened
before the switch goes on reading the old files; a failed write changes
nothing. Old versions are removed by age.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from curbsight.sources.storage import _delete, _file_system

_VERSION = re.compile(r"v-(\d{13})-[0-9a-f]{32}")


def publish(df: DataFrame, name: str, root: str) -> str:
    """Write a new version under ``root`` and make it what ``name`` shows; the schema may change. Gives its folder."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}/v-{int(time.time() * 1000):013d}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM parquet.`{path}`")
    return path


def current(spark: SparkSession, name: str) -> str | None:
    """The folder of the version that ``name`` shows; None if it was never published."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").where("col_name = 'View Text'").first()
    found = text and re.search(r"parquet\.`(.+)`", text["data_type"])
    return found[1] if found else None


def versions(spark: SparkSession, name: str, root: str) -> list[str]:
    """Folders of all versions, oldest first, those of failed writes among them."""
    folder = f"{root.rstrip('/')}/{name}"
    files = _file_system(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not files.exists(path):
        return []
    return sorted(f"{folder}/{s.getPath().getName()}" for s in files.listStatus(path) if _VERSION.fullmatch(s.getPath().getName()))


def expire(spark: SparkSession, name: str, root: str, seconds: float) -> list[str]:
    """Delete versions older than that, but never the current one; gives their folders.

    ``seconds`` is longer than any reader needs: one that still reads a
    version that goes will fail.
    """
    shown, before = current(spark, name), (time.time() - seconds) * 1000
    gone = [v for v in versions(spark, name, root) if v != shown and int(_VERSION.search(v)[1]) < before]
    for version in gone:
        _delete(spark, version)
    return gone
