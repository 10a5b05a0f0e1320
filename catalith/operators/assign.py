"""Assignment of new items to existing clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from .knn import attach_nearest
from .pairwise import numbered


def assign_new(
    new_items: DataFrame,
    centroids: DataFrame,
    threshold: float | None = None,
    metric: str = "cosine",
    id_column: str | None = "item_id",
    vector_column: str = "embedding",
    **options,
) -> DataFrame:
    """``(item_id, assigned_cluster, score, rank)``: the best cluster per item.

    A score below ``threshold`` gives cluster -1. Pass ``id_column=None`` for
    items without an id: they get row numbers.
    """
    if id_column is None:
        # Written, so that the numbers stay what they are.
        rows = numbered(new_items.select(vector_column), "item_id").select(
            F.col("item_id").cast("string").alias("item_id"), vector_column
        )
    else:
        rows = new_items.select(F.col(id_column).alias("item_id"), vector_column)
    hits = attach_nearest(
        rows, centroids, metric=metric, vector_column=vector_column, **options
    )
    label = vectors.threshold_label(F.col("score"), F.col("cluster_id"), threshold)
    return hits.select("item_id", label.alias("assigned_cluster"), "score", F.lit(1).alias("rank"))
