"""Sinks: Parquet tables, vectors, JSON and cell-partitioned catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet table.

    Rows are rebalanced on the partition columns first, so that a small value
    makes one file and a hot one is split over several tasks.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_vectors(df: DataFrame, path: str) -> None:
    write_table(df, path)


def unmatched_keys(vectors: DataFrame, items: DataFrame, key: str = "item_id") -> DataFrame:
    """Keys on one side only: ``(side, n)``; empty when both sides agree."""
    without_item = vectors.join(items, key, "left_anti").select(F.lit("vectors").alias("side"))
    without_vector = items.join(vectors, key, "left_anti").select(F.lit("items").alias("side"))
    both = without_item.unionAll(without_vector)
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; list columns stay lists."""
    df.write.mode("overwrite").json(path)


def write_cells(catalog: DataFrame, centroids: DataFrame, path: str) -> None:
    """A catalogue partitioned by ``cell_id`` and the centroids of its cells."""
    write_table(catalog, f"{path}/members", ["cell_id"])
    write_table(centroids, f"{path}/centroids")
