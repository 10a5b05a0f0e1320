"""Compare every row of one vector table with rows of another, in blocks.

Vectors are compared as matrix products inside tasks and only reduced rows
leave a task, so pairs never become rows. Three plans give the same result:

* ``right``: the right table is small enough to broadcast. Left rows stay
  where they are and nothing is shuffled or written.
* ``left``: the left table is small enough to broadcast. Right rows stay where
  they are, nothing of them is written, and each task emits one reduced result
  per left row.
* ``blocks``: both tables are large. The right table is written once to the shared
  folder. Each task takes blocks of its left rows and reads the right table's files
  block by block. No vector is shuffled, and no row is repeated for pairs of blocks.

A side beyond the broadcast limit is never sent whole: ``right`` and ``left`` then go
over to ``blocks``. ``block_rows`` is how many rows a block has at least. Blocks have
``LEAST_ROWS`` or more in any case, as each left block reads the right table once.

Under ``right`` and ``blocks`` a task sees all right rows, so its results are
complete; after ``left`` the caller merges the partial results. Rows of a block are
told apart by their place, the column ``LEFT_ROW``, never by their ids, so null and
repeated ids give the same result under every plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BROADCAST_BYTES, materialize, write_shared

LEFT_ROW = "left_row"

# Rows of one block: 50,000 vectors of 768 numbers are 300 MB as double.
BLOCK_ROWS = 50_000
# Rows of a block even if fewer are asked for, unless the table ends.
LEAST_ROWS = 8_192
# Numbers in one score matrix: 8 MB as double.
TILE_NUMBERS = 1_000_000

# Bytes of a row besides what is measured: offsets and row numbers.
_ROW_BYTES = 32


class Kernel(Protocol):
    """What happens between a table of left rows, with ``LEFT_ROW``, and a table of right rows."""

    def prepare(self, right: pa.Table) -> object: ...

    def compare(self, left: pa.Table, prepared: object, so_far: pa.Table | None = None) -> pa.Table:
        """Reduced rows, with ``LEFT_ROW``; of ``so_far`` it may leave out what the merge would drop."""

    def merge(self, partial: pa.Table) -> pa.Table:
        """One reduced result from those of several right tables.

        A kernel may have ``finish`` besides, which takes a complete result.
        """


def to_matrix(vectors: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    """A list column as an ``(n, d)`` matrix, of doubles unless another ``kind`` is given."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=kind is np.float64)
    lengths = np.diff(vectors.offsets.to_numpy(zero_copy_only=False))
    if vectors.null_count or (lengths != lengths[0]).any():
        raise ValueError("vectors must be present and of one length")
    return flat.reshape(len(vectors), -1)


def same_length(q: np.ndarray, c: np.ndarray) -> None:
    if len(q) and len(c) and q.shape[1] != c.shape[1]:
        raise ValueError(f"vectors of {q.shape[1]} and of {c.shape[1]} numbers cannot be compared")


def tiles(rows: int, columns: int):
    """Ranges of left rows whose score matrix stays within the tile size."""
    step = max(1, TILE_NUMBERS // max(1, columns))
    return ((start, min(rows, start + step)) for start in range(0, rows, step))


def is_small(df: DataFrame, vector: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` takes at most ``limit`` bytes with its vectors as doubles.

    One job sums the lengths of the vectors and of all other columns as text.
    """
    others = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns if c != vector]
    row = F.coalesce(F.size(vector), F.lit(0)) * 8 + sum(others, F.lit(_ROW_BYTES))
    return (df.agg(F.sum(row.cast("long"))).first()[0] or 0) <= limit


def with_rows(table: pa.Table) -> pa.Table:
    """``table`` with the place of each row."""
    return table.append_column(LEFT_ROW, pa.array(np.arange(len(table))))


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows, but for the last, from the batches of a task."""
    waiting, n = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(waiting)
            waiting, n = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def stored_blocks(path: str, columns: list[str], rows: int) -> Iterator[pa.Table]:
    """The rows of a Parquet table in the shared folder, some ``rows`` at a time."""
    system, name = fs.FileSystem.from_uri(path)
    source = ds.dataset(name, filesystem=system, format="parquet", exclude_invalid_files=False)
    batches = source.to_batches(columns=columns, batch_size=rows, batch_readahead=1, fragment_readahead=1)
    return gathered(batches, rows)


def stored_table(path: str, columns: list[str]) -> pa.Table | None:
    """A Parquet table in the shared folder, if there is one."""
    system, name = fs.FileSystem.from_uri(path)
    if system.get_file_info(name).type == fs.FileType.NotFound:
        return None
    return pa.concat_tables(stored_blocks(path, columns, LEAST_ROWS))


def compare_all(kernel: Kernel, left: pa.Table, rights: Iterator[pa.Table]) -> pa.Table | None:
    """The merged result of one left table and several right ones."""
    partial = None
    for right in rights:
        out = kernel.compare(left, kernel.prepare(right), partial)
        partial = out if partial is None else kernel.merge(pa.concat_tables([partial, out]))
    return partial


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _finished(kernel: Kernel, complete: pa.Table, names: list[str]) -> pa.Table:
    finish = getattr(kernel, "finish", None)
    return (finish(complete) if finish else complete).select(names)


def _map_right(left: DataFrame, right: DataFrame, kernel: Kernel, schema) -> DataFrame:
    spark = left.sparkSession
    prepared = spark.sparkContext.broadcast(kernel.prepare(right.toArrow()))
    names = schema.names

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = kernel.compare(with_rows(pa.Table.from_batches([batch])), prepared.value)
                yield from _finished(kernel, out, names).to_batches()

    return left.mapInArrow(run, schema)


def _map_left(left: DataFrame, right: DataFrame, kernel: Kernel, schema, block_rows) -> DataFrame:
    shared = left.sparkSession.sparkContext.broadcast(with_rows(left.toArrow()))
    schema = T.StructType([T.StructField(LEFT_ROW, T.LongType()), *schema.fields])
    names = schema.names

    def run(batches):
        partial = compare_all(kernel, shared.value, gathered(batches, block_rows))
        if partial is not None:
            yield from partial.select(names).to_batches()

    return right.mapInArrow(run, schema)


def _map_blocks(left: DataFrame, right: DataFrame, kernel: Kernel, schema, block_rows) -> DataFrame:
    path = write_shared(right)
    columns, names = right.columns, schema.names

    def run(batches):
        for block in gathered(batches, block_rows):
            found = compare_all(kernel, with_rows(block), stored_blocks(path, columns, block_rows))
            if found is not None:
                yield from _finished(kernel, found, names).to_batches()

    return left.mapInArrow(run, schema)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once, with a number for each row that no other row has."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()))


def pairwise(
    left: DataFrame,
    right: DataFrame,
    kernel: Kernel,
    schema: T.StructType,
    left_vector: str,
    right_vector: str,
    plan: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
    least_rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """Reduced rows of the comparison, and whether they still need merging.

    Rows that need merging have ``LEFT_ROW`` before the columns of ``schema``. A
    side beyond the broadcast limit is read in blocks, also if the plan is given.
    """
    block_rows = max(block_rows, LEAST_ROWS if least_rows is None else least_rows)
    if plan in ("right", "left"):
        side, vector = (right, right_vector) if plan == "right" else (left, left_vector)
        if not is_small(side, vector, broadcast_bytes):
            plan = "blocks"
    if plan == "auto":
        if is_small(right, right_vector, broadcast_bytes):
            plan = "right"
        elif is_small(left, left_vector, broadcast_bytes):
            plan = "left"
        else:
            plan = "blocks"
    left = left.where(F.col(left_vector).isNotNull())
    right = right.where(F.col(right_vector).isNotNull())
    if plan == "right":
        return _map_right(left, right, kernel, schema), False
    if plan == "left":
        return _map_left(left, right, kernel, schema, block_rows), True
    if plan == "blocks":
        return _map_blocks(left, right, kernel, schema, block_rows), False
    raise ValueError(f"unknown plan: {plan}")
