"""Shared folder and materialisation helpers."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Largest table, in bytes of its numbers, that is sent whole to every executor.
BROADCAST_BYTES = 64 << 20


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="catalith-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


_written: dict[int, list[str]] = {}


def write_shared(df: DataFrame, partition_by: list[str] | None = None) -> str:
    """Write ``df`` to a table of its own in the shared folder; returns its path."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/catalith-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _written.setdefault(id(spark.sparkContext), []).append(path)
    return path


def materialize(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on the lineage of ``df``, is columnar, and
    survives the loss of any executor.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_shared(df, partition_by))


def clear_materialized(spark: SparkSession) -> int:
    """Delete the tables that :func:`write_shared` wrote for this application.

    Call it when no result that reads them is needed any more. Returns how many
    there were.
    """
    paths = _written.pop(id(spark.sparkContext), [])
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


# Bytes of a scan that one core takes without harm.
SPLIT_BYTES = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores when it is estimated to be too small to have a split for each.

    The estimate is the planner's, so nothing runs for it. Large inputs have more
    splits and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SPLIT_BYTES else df
