"""Working tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_current: ContextVar[str | None] = ContextVar("tillroll_job_folder", default=None)


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """A working folder that takes all tables written within, and goes at the end with all of them."""
    folder = working_folder(spark)
    token = _current.set(folder)
    try:
        yield folder
    finally:
        _current.reset(token)
        remove(spark, folder)


def working_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; removed when the application ends.

    Only a local session without that setting gets a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="tillroll-")
    folder = f"{base.rstrip('/')}/tillroll-{uuid.uuid4().hex}"
    path, file_system = hadoop_path(spark, folder)
    file_system.mkdirs(path)
    file_system.deleteOnExit(path)
    return folder


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def is_without_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is the folder of a dataset that was written without a row, hence without a schema."""
    found, file_system = hadoop_path(spark, path)
    if not file_system.exists(found) or not file_system.getFileStatus(found).isDirectory():
        return False
    return all(entry.getPath().getName().startswith(("_", ".")) for entry in file_system.listStatus(found))


def remove(spark: SparkSession, path: str) -> None:
    found, file_system = hadoop_path(spark, path)
    file_system.delete(found, True)


def materialise(df: DataFrame, path: str | None = None, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so that its rows no longer depend on lost executors.

    Without ``path`` the table goes into the folder of the current job, or else into a new one that stays
    until the application ends.
    """
    spark = df.sparkSession
    if path is None:
        job = _current.get()
        path = f"{job}/table-{uuid.uuid4().hex}" if job else working_folder(spark) + "/table"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
