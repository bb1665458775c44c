"""Where intermediate tables go.

Tasks on any executor must be able to read them back, also after the executor
that wrote them is gone. So they live in the shared folder the cluster names
in ``spark.checkpoint.dir``; a machine-local folder is used only by a local
session that has no such setting.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


_plan: ContextVar[str] = ContextVar("plan", default="")
#: Applications and folders of theirs that tasks have found.
_found: set[tuple[str, str]] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    Off a local master a path without a scheme must not land on the machines'
    own disks. It is taken if Spark keeps its checkpoints there and the executors
    find them. A ``file:`` URL says that the folder is a mount all machines share.
    """
    context = spark.sparkContext
    local = re.fullmatch(r"local(\[[^\]]*\])?", context.master) is not None
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not local:
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="curbsight-")
        context.setCheckpointDir(folder)
    elif not local and ":" not in folder and _file_system(spark, folder).getScheme() == "file" and not _is_mounted(spark, folder):
        raise ValueError(f"{folder} is a folder of each machine; name a shared one in {CHECKPOINT_SETTING}")
    return folder.rstrip("/")


def _is_mounted(spark: SparkSession, folder: str) -> bool:
    """Whether tasks find what Spark's driver has made for checkpoints in this folder.

    Some tasks for each core look for it, once per application.
    """
    context = spark.sparkContext
    made = re.sub("^file:/*", "/", context.getCheckpointDir() or "")
    if os.path.dirname(made) != os.path.normpath(folder):
        return False
    own = context.applicationId, made
    if own not in _found:
        tasks = 4 * context.defaultParallelism
        if not all(context.parallelize(range(tasks), tasks).map(lambda _: os.path.isdir(made)).collect()):
            return False
        _found.add(own)
    return True


def new_location(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet."""
    return f"{_own_folder(spark)}{_plan.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is written in between; nothing read later may depend on it."""
    own = _plan.get() + f"/plan-{uuid.uuid4().hex}"
    token = _plan.set(own)
    try:
        yield
    finally:
        _plan.reset(token)
        _delete(spark, _own_folder(spark) + own)


def clear(spark: SparkSession) -> None:
    """Delete what this application has written here, once no frame reads it any more.

    Catalog tables with files here should be dropped first, see :func:`drop_tables`.
    """
    _delete(spark, _own_folder(spark))


def drop_tables(spark: SparkSession) -> None:
    """Take tables out of the current catalog schema whose files this application has written here."""
    own = _own_folder(spark)
    for table in spark.catalog.listTables():
        if not table.isTemporary:
            details = spark.sql(f"DESCRIBE TABLE EXTENDED `{table.name}`").where("col_name = 'Location'").first()
            if details is not None and own.split(":")[-1].lstrip("/") in details["data_type"]:
                spark.sql(f"DROP TABLE `{table.name}`")


def _delete(spark: SparkSession, folder: str) -> None:
    _file_system(spark, folder).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder), True)


def _file_system(spark: SparkSession, folder: str):
    context = spark.sparkContext
    return context._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(context._jsc.hadoopConfiguration())


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/curbsight/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back.

    Later steps then start from files, not from a recomputation, and Spark
    knows the real size when it picks a join strategy.
    """
    path = new_location(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
