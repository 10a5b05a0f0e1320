"""New items as a stream of files: clusters and neighbours as they arrive.

The catalogue and the centroids are tables; only the new items stream. Assignment keeps
no state, so it is one map over the stream. Neighbours are searched per micro-batch,
which writes its rows to a folder named by the batch, so a batch that is run again
replaces its own rows. With ``availableNow`` a run takes what has arrived since the last
one, as its checkpoint tells, and ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.assign import assign_new
from ..operators.knn import nearest, nearest_in_cells


def _started(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def assign_stream(
    new_items: DataFrame,
    centroids: DataFrame,
    out: str,
    checkpoint: str,
    threshold: float | None = None,
    **options,
) -> StreamingQuery:
    """Append ``(item_id, assigned_cluster, score, rank)`` of streamed vectors to ``out``.

    ``new_items`` is a stream with an id and a vector, ``centroids`` a table within the
    broadcast limit. See :func:`..operators.assign.assign_new` for the rest.
    """
    found = assign_new(new_items, centroids, threshold, **options)
    return _started(found.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def neighbors_stream(
    new_items: DataFrame,
    catalog: DataFrame,
    out: str,
    checkpoint: str,
    k: int = 5,
    metric: str = "cosine",
    cells: DataFrame | None = None,
    **options,
) -> StreamingQuery:
    """Write the ``k`` nearest catalogue rows of streamed vectors below ``out``, by batch.

    With ``cells`` the catalogue must carry a ``cell_id``; of a stored one only the
    cells that a batch probes are read.
    """

    def search(batch: DataFrame, number: int) -> None:
        if cells is None:
            found = nearest(batch, catalog, k, metric, **options)
        else:
            found = nearest_in_cells(batch, catalog, cells, k, metric=metric, **options)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _started(new_items.writeStream.foreachBatch(search), checkpoint)
