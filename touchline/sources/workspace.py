"""The shared folder in which intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="touchline-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back on a temporary folder, one per application: on a
    cluster the other machines could not read it. No setting of the session is changed.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can read")
    return _local_folder(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def pinned(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that its plan is neither repeated nor lost
    with an executor."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_workspace(spark: SparkSession) -> None:
    """Delete the intermediate tables that this process has written so far.

    Call it when the results that were built on them have been used or stored.
    """
    delete_folders(spark, _written)
    _written.clear()


def delete_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)
