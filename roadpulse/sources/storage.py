"""Shared storage for tables and models handed from one job to the next."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, visible to every executor.

    A session without that setting uses a folder in its warehouse, which is
    storage of the session's own choosing and not of one machine.
    """
    configured = spark.conf.get(_CONF, None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_staged"


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Remove the tables staged inside when it ends, also by an error; what is to stay must be written elsewhere by then."""
    folder = new_path(spark, "scratch")
    before = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(before)
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def save(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` at ``path`` and continue from the files."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and continue from the files.

    For tables several consumers read, and for results an iterative fit scans
    repeatedly: lost executors re-read files instead of replaying the lineage.
    Inside :func:`scratch` the table goes when the work around it is done.
    """
    folder = _scratch.get()
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_path(df.sparkSession, name)
    return save(df, path, partition_by)
