"""Shards of nearly equal bytes by longest-processing-time scheduling.

Rows of equal texts form a group that stays together. Groups go, largest first,
to the least loaded shard, which a heap finds.

The heap holds a bounded number of items at every scale. A group of at least
one ``SINGLE``-th of all bytes is an item of its own, so there are at most
``SINGLE`` of those. All smaller groups travel in ``BUNDLES`` bundles by the hash
of their text, and each bundle is one item.

Defined cases: a null text has no bytes and a CRC of 0, and null texts are a
group of their own, apart from empty texts. Null and repeated keys are ordinary
rows. Equal sizes are placed in the order of their digest. An empty table gives
no rows. Only the key, the text and the columns named in ``keep`` are read, so
other columns cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.session import materialize

SINGLE = 65_536
BUNDLES = 16_384


def schedule(items: list[tuple[int, bytes | None, int | None]], shards: int) -> list[int]:
    """The shard of each ``(bytes, group, bundle)``: largest first, to the least load."""
    order = sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1] or b"", items[i][2] or 0))
    heap = [(0, shard) for shard in range(shards)]
    placed = [0] * len(items)
    for i in order:
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + items[i][0], shard))
        placed[i] = shard
    return placed


def _numbered(shards: int):
    """Number the rows of each shard within one task."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(shards, dtype=np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy(zero_copy_only=False)
            counts = np.bincount(shard, minlength=shards)
            order = np.argsort(shard, kind="stable")
            local = np.empty(len(shard), dtype=np.int64)
            local[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts - seen, counts)
            seen += counts
            columns = [*batch.columns, pa.array(np.full(len(shard), part, dtype=np.int64)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "local"])

    return number


def assign_shards(
    df: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(key, *keep, size, text_crc32, shard, slot)`` of every row of ``df``.

    ``size`` is the UTF-8 bytes of the text plus 1; ``slot`` counts the rows of a
    shard from 0 without gaps.
    """
    spark = df.sparkSession
    whole = F.encode(F.col(text), "utf-8")
    thin = materialize(
        df.select(
            F.col(key).alias("row_key"),
            (F.coalesce(F.octet_length(whole), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(whole), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.unhex(F.md5(whole)), F.lit(b"null")).alias("text_group"),
            *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)),
        )
    )
    total = thin.agg(F.sum("size")).first()[0] or 0
    groups = thin.groupBy("text_group").agg(F.sum("size").alias("bytes"))
    large = F.col("bytes") * SINGLE >= F.lit(total)
    bundle = F.pmod(F.xxhash64("text_group"), F.lit(BUNDLES))
    items = (
        groups.select(
            F.when(large, F.col("text_group")).alias("alone"), F.when(~large, bundle).alias("bundle"), "bytes"
        )
        .groupBy("alone", "bundle")
        .agg(F.sum("bytes").alias("bytes"))
        .collect()  # at most SINGLE + BUNDLES rows
    )
    items = [(r["bytes"], bytes(r["alone"]) if r["alone"] is not None else None, r["bundle"]) for r in items]
    placed = schedule(items, shards)
    alone = spark.createDataFrame(
        [(bytearray(g), s) for (_, g, _), s in zip(items, placed, strict=True) if g is not None],
        "text_group binary, alone_shard int",
    )
    bundles = spark.createDataFrame(
        [(b, s) for (_, g, b), s in zip(items, placed, strict=True) if g is None], "bundle long, bundle_shard int"
    )
    # Both tables are bounded by SINGLE and BUNDLES rows, whatever the input.
    rows = (
        thin.withColumn("bundle", bundle)
        .join(F.broadcast(alone), "text_group", "left")
        .join(F.broadcast(bundles), "bundle", "left")
        .withColumn("shard", F.coalesce("alone_shard", "bundle_shard"))
        .drop("alone_shard", "bundle_shard", "bundle", "text_group")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", part long, local long"
    numbered = materialize(rows.mapInArrow(_numbered(shards), schema))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        numbered.groupBy("part", "shard")
        .count()
        .select("part", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    return numbered.join(offsets, ["part", "shard"]).select(
        F.col("row_key").alias(key),
        *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)),
        "size",
        "text_crc32",
        "shard",
        (F.col("offset") + F.col("local")).alias("slot"),
    )


def write_shards(df: DataFrame, path: str, shards: int = 16, key: str = "doc_id", text: str = "text") -> None:
    """Write every column of ``df`` into one folder per shard under ``path``."""
    others = tuple(c for c in df.columns if c != key)
    placed = assign_shards(df, shards, key, text, others)
    placed.write.partitionBy("shard").parquet(path)
