"""Near-duplicate texts by a chosen-path similarity join.

A text is its set of distinct word shingles. Equal sets are one class from the
start, so copies cost one row each. A class has a sketch of minwise tokens: for
each of ``TOKENS`` hash functions, the least token of its set.

Every tree starts with all classes at its root. A node chooses one or two of the
minwise tokens (five in four nodes on average, the inverse of the similarity
asked for) and branches its classes by them, so similar sets stay together with
a probability that does not fall with the depth and others part. A node that is
small enough is compared exhaustively by sketches. ``TREES`` independent trees
repeat this: at the least similarity a pair is missed by all of them with a
probability below 2e-4 if its nodes are three levels deep, and below 1e-6 if one
level is enough. Nodes that are still large at the last level are mostly one
group of near copies; they are compared in pairs of blocks.

Pairs that look similar only group the classes that are compared on full sets.
These are made anew from the whole texts of the classes concerned, one text per
class, and a pair is linked by exact counts. Within a comparison, classes that
are linked already are not compared again, and every task returns a spanning
forest instead of pairs, so the output grows with the number of classes.

Defined cases: a null text and one without words have no shingles and link with
nothing. Fewer words than a shingle are one shingle. Rows that repeat are one
class. A null key is never the least key of a component unless all keys in it
are null. An empty table gives no rows. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.graph import components
from catalith.llm.words import mix, shingle_set, texts_of
from catalith.session import materialize

TOKENS = 64
TREES = 8
DEPTH = 3
NODE = 512
#: Texts of a block when a large group is compared on full sets; a task takes two blocks.
BLOCK = 192
BLOCK_SHINGLES = 1 << 21
#: A pair at 0.8 shares 51 of 64 tokens on average; fewer than 38 has a probability of 5e-5.
SHARED = 38
#: SHARED, DEPTH and TREES find pairs of this similarity and above; below it they would lose links.
LEAST_PERCENT = 80
#: Rows of keys and hashes, of about 100 bytes each, that are sent to every executor.
BROADCAST_ROWS = 200_000

_rng = np.random.default_rng(77)
_FACTORS = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64) | np.uint64(1)
_TERMS = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64)


def sketches(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minwise tokens of sets laid out one after the other; no set may be empty."""
    out = np.empty((len(starts), TOKENS), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for i in range(TOKENS):
            out[:, i] = np.minimum.reduceat(tokens * _FACTORS[i] + _TERMS[i], starts) >> np.uint64(32)
    return out


def _describe(width: int):
    """Size, digest and sketch of each text of a batch."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [shingle_set(t, width) for t in texts_of(batch.column("body"))]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                digests = [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
                packed: list[bytes | None] = [None] * len(sets)
                filled = np.flatnonzero(sizes)
                if len(filled):
                    starts = np.concatenate(([0], np.cumsum(sizes[filled])[:-1]))
                    for i, row in zip(filled, sketches(np.concatenate(sets), starts), strict=True):
                        packed[i] = row.tobytes()
                columns = [batch.column("row_key"), batch.column("text_hash"), pa.array(sizes)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
                    ["row_key", "text_hash", "n_shingles", "digest", "sketch"],
                )

    return describe


def _sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, TOKENS)


def _children(nodes: np.ndarray, rows: np.ndarray, sketch: np.ndarray, coordinate: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = sketch[rows, coordinate].astype(np.uint64)
        return mix(mix(nodes * np.uint64(0x9E3779B97F4A7C15) + coordinate.astype(np.uint64)) ^ values).view(np.int64)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Branch the roots: every fourth tree by two tokens, the others by one."""
    for batch in batches:
        sketch = _sketch_rows(batch.column("sketch"))
        rows = np.arange(len(sketch))
        for tree in range(TREES):
            for branch in range(2 if tree % 4 == 0 else 1):
                nodes = np.full(len(rows), tree, dtype=np.uint64)
                coordinate = np.full(len(rows), 2 * tree + branch)
                children = _children(nodes, rows, sketch, coordinate)
                yield pa.RecordBatch.from_arrays([pa.array(children), batch.column("class")], ["node", "class"])


def _branches(level: int):
    """Branch each node by one token, every fourth node by two."""
    first, span = 2 * TREES, (TOKENS - 2 * TREES) // (DEPTH - 1)
    first += (level - 1) * span

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = _sketch_rows(batch.column("sketch"))
            nodes = batch.column("node").to_numpy().view(np.uint64)
            chosen = mix(nodes)
            one = (chosen % np.uint64(span)).astype(np.int64)
            # The second token differs from the first.
            two = (one + 1 + (chosen >> np.uint64(20)).astype(np.int64) % (span - 1)) % span
            again = np.flatnonzero((chosen >> np.uint64(60)) % np.uint64(4) == 0)
            for rows, offset in ((np.arange(len(nodes)), one), (again, two)):
                children = _children(nodes[rows], rows, sketch, first + offset[rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(children), batch.column("class").take(pa.array(rows))], ["node", "class"]
                )

    return branch


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a sorted partition into tables that end between groups."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        same = np.ones(batch.num_rows, dtype=bool)
        for key in keys:
            column = batch.column(key).to_numpy(zero_copy_only=False)
            same &= column == column[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield pa.concat_tables([*held, table.slice(0, cut)]).combine_chunks()
            held = [table.slice(cut)]
        elif held and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys):
            held.append(table)
        else:
            if held:
                yield pa.concat_tables(held).combine_chunks()
            held = [table]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a`` and ``b``: every place points to the least of its set."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        # Point the roots, not only the ends, to the smaller label.
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def _alike(percent: int):
    """Links between classes of one node whose sketches agree in ``SHARED`` tokens."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["node", "part"]):
            node = table.column("node").to_numpy()
            part = table.column("part").to_numpy()
            side = table.column("side").to_numpy()
            size = table.column("n_shingles").to_numpy()
            sketch = _sketch_rows(table.column("sketch").combine_chunks())
            first = np.concatenate(([True], (node[1:] != node[:-1]) | (part[1:] != part[:-1])))
            starts = np.flatnonzero(first)
            ends = np.append(starts[1:], len(node))
            end = np.repeat(ends, ends - starts)
            label = np.arange(len(node))
            left = np.arange(len(node))
            for step in range(1, int((ends - starts).max())):
                left = left[left + step < end[left]]
                right = left + step
                open_ = label[left] != label[right]
                # In a pair of blocks only rows of different blocks are compared.
                open_ &= (side[left] != side[right]) | (side[left] < 0)
                a, b = left[open_], right[open_]
                low, high = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
                fit = 100 * low >= percent * high
                a, b = a[fit], b[fit]
                alike = (sketch[a] == sketch[b]).sum(axis=1) >= SHARED
                if alike.any():
                    label = merge(label, a[alike], b[alike])
            cls = table.column("class").to_numpy()
            linked = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(cls[linked]), pa.array(cls[label[linked]])], ["a", "b"])

    return compare


def in_blocks(df: DataFrame, group: str, blocks: str, item: str) -> DataFrame:
    """Deal the rows of a group into ``blocks`` blocks and repeat them for every pair of blocks.

    Adds ``part``, the pair, and ``side``: the block, or -1 in the pair of a block
    with itself, where all rows are compared.
    """
    own = F.pmod(F.xxhash64(item), F.col(blocks)).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda other: other.cast("int"))
    dealt = df.withColumn("own", own).withColumn("other", F.explode(others))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select(
        *df.columns,
        (low.cast("long") * F.col(blocks) + high).alias("part"),
        F.when(F.col("own") == F.col("other"), F.lit(-1)).otherwise(F.col("own")).alias("side"),
    )


def by_group(df: DataFrame, keys: list[str], kernel: Callable, schema: str) -> DataFrame:
    """Run ``kernel`` over partitions in which the rows of a group are together."""
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(kernel, schema)


def candidate_links(classes: DataFrame, percent: int) -> DataFrame:
    """Spanning links of classes whose sketches are alike in some node of some tree."""
    rows = materialize(classes.select("class", "sketch").mapInArrow(_roots, "node long, class long"))
    found = []
    for level in range(1, DEPTH + 1):
        sizes = materialize(rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"))
        sized = rows.join(sizes, "node")
        last = level == DEPTH
        small = sized if last else sized.where(F.col("size") <= NODE)
        found.append(small.select("node", "class", F.ceil(F.col("size") / NODE).cast("int").alias("blocks")))
        if last or not sizes.where(F.col("size") > NODE).limit(1).count():
            break
        large = sized.where(F.col("size") > NODE).select("node", "class")
        split = large.join(classes.select("class", "sketch"), "class")
        rows = materialize(split.mapInArrow(_branches(level), "node long, class long"))
    leaves = found[0]
    for more in found[1:]:
        leaves = leaves.unionByName(more)
    described = leaves.join(classes.select("class", "n_shingles", "sketch"), "class")
    dealt = in_blocks(described, "node", "blocks", "class")
    kept = dealt.select("node", "part", "side", "class", "n_shingles", "sketch")
    return by_group(kept, ["node", "part"], _alike(percent), "a long, b long").distinct()


def _exact(width: int, percent: int):
    """Links between classes of one group whose full sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["root", "part"]):
            root = table.column("root").to_numpy()
            part = table.column("part").to_numpy()
            first = np.concatenate(([True], (root[1:] != root[:-1]) | (part[1:] != part[:-1])))
            starts = np.flatnonzero(first)
            a, b = [], []
            for start, end in zip(starts, np.append(starts[1:], len(root)), strict=True):
                for i, j in _verified(table.slice(int(start), int(end - start)), width, percent):
                    a.append(i)
                    b.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return verify


def _verified(table: pa.Table, width: int, percent: int) -> Iterator[tuple[int, int]]:
    if table.num_rows < 2:
        return
    cls = table.column("class").to_numpy()
    side = table.column("side").to_numpy()
    sets = []
    for chunk in table.column("body").chunks:
        sets.extend(shingle_set(t, width) for t in texts_of(chunk))
    size = np.array([len(s) for s in sets])
    label = np.arange(len(sets))
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        low, high = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        fit = (label[rest] != label[i]) & (100 * low >= percent * high) & (cls[rest] != cls[i])
        fit &= (side[rest] != side[i]) | (side[rest] < 0)
        rest = rest[fit]
        if not len(rest):
            continue
        tokens = np.concatenate([sets[j] for j in rest])
        at = np.minimum(np.searchsorted(sets[i], tokens), size[i] - 1)
        starts = np.concatenate(([0], np.cumsum(size[rest])[:-1]))
        common = np.add.reduceat((sets[i][at] == tokens).astype(np.int64), starts)
        similar = rest[100 * common >= percent * (size[rest] + size[i] - common)]
        if len(similar):
            # One link per set that was not reached before.
            fresh = similar[np.unique(label[similar], return_index=True)[1]]
            label = merge(label, np.full(len(fresh), i), fresh)
            yield from ((int(cls[i]), int(cls[j])) for j in fresh)


def verified_links(
    docs: DataFrame, classes: DataFrame, candidates: DataFrame, width: int, percent: int, broadcast_rows: int
) -> DataFrame:
    """Links confirmed on full sets, as a spanning forest of each comparison."""
    grouped = components(candidates).select(F.col("node").alias("class"), "root")
    wanted = materialize(grouped.join(classes.select("class", "n_shingles", "rep"), "class"))
    sizes = materialize(
        wanted.groupBy("root").agg(
            F.greatest(
                F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
            ).cast("int").alias("blocks")
        )
    )
    wanted = materialize(
        wanted.join(sizes, "root").select("class", "root", "blocks", "rep.text_hash", F.col("rep.row_key").alias("rep_key"))
    )
    side = F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted
    same = (F.col("d.text_hash") == F.col("w.text_hash")) & F.col("d.row_key").eqNullSafe(F.col("w.rep_key"))
    texts = docs.alias("d").join(side.alias("w"), same).select("class", "root", "blocks", "body")
    dealt = in_blocks(texts, "root", "blocks", "class").select("root", "part", "side", "class", "body")
    return by_group(dealt, ["root", "part"], _exact(width, percent), "a long, b long").distinct()


def _grouped(df: DataFrame, key: str, text: str, width: int, percent: int, broadcast_rows: int) -> DataFrame:
    """``(row_key, text_hash, n_shingles, digest, first)`` of every row.

    ``first`` is the first row of the component by key and text, null without words.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"trees and sketches are laid out for {LEAST_PERCENT} to 100 percent, not {percent}")
    docs = df.select(F.col(key).alias("row_key"), F.col(text).cast("string").alias("body")).select(
        "*", F.xxhash64("body").alias("text_hash")
    )
    kind = docs.schema["row_key"].dataType.simpleString()
    thin = materialize(
        docs.mapInArrow(
            _describe(width),
            f"row_key {kind}, text_hash long, n_shingles long, digest binary, sketch binary",
        )
    )
    classes = materialize(
        thin.where("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.first("sketch").alias("sketch"),
            F.first("n_shingles").alias("n_shingles"),
            # The least key that is not null; the text decides between equal keys.
            F.min(F.struct(F.col("row_key").isNull().alias("no_key"), "row_key", "text_hash")).alias("first"),
            F.min(F.struct("text_hash", "row_key")).alias("rep"),
        )
        .withColumn("class", F.monotonically_increasing_id())
    )
    candidates = candidate_links(classes, percent)
    links = verified_links(docs, classes, candidates, width, percent, broadcast_rows)
    members = materialize(
        components(links).join(classes.select(F.col("class").alias("node"), "digest", "first"), "node")
    )
    least = materialize(members.groupBy("root").agg(F.min("first").alias("first")))
    merged = materialize(members.drop("first").join(least, "root").select("digest", "first"))
    alone = classes.join(merged.select("digest"), "digest", "left_anti").select("digest", "first")
    of_class = materialize(merged.unionByName(alone))
    return thin.drop("sketch").join(of_class, "digest", "left")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(key, text_hash, n_shingles, component_id, kept)`` of every row.

    Sets are linked where ``100 * common >= percent * all``; ``component_id`` is
    the least key that can be reached, and ``kept`` tells that it is the own one.
    A ``percent`` below ``LEAST_PERCENT`` is refused.
    """
    found = _grouped(df, key, text, width, percent, broadcast_rows)
    component = F.when(F.col("digest").isNull(), F.col("row_key")).otherwise(F.col("first.row_key"))
    return found.select(
        F.col("row_key").alias(key),
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("row_key").eqNullSafe(component).alias("kept"),
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``df``: the first by key, null keys last, and text."""
    found = _grouped(df, key, text, width, percent, BROADCAST_ROWS)
    first = F.col("row_key").eqNullSafe(F.col("first.row_key")) & (F.col("text_hash") == F.col("first.text_hash"))
    found = found.where(F.col("digest").isNull() | first).select(
        F.col("row_key").alias("kept_key"), F.col("text_hash").alias("kept_hash")
    )
    kept = materialize(found.groupBy("kept_key", "kept_hash").agg(F.count("*").alias("repeats")))
    names = {c: f"doc_{i}" for i, c in enumerate(df.columns)}
    docs = df.select(*(F.col(c).alias(n) for c, n in names.items()))
    docs = docs.withColumn("own_hash", F.xxhash64(F.col(names[text]).cast("string")))
    same = F.col(names[key]).eqNullSafe(F.col("kept_key")) & (F.col("own_hash") == F.col("kept_hash"))
    rows = docs.join(kept, same).drop("kept_key", "kept_hash")
    # Texts without words are no copies of each other; only rows that repeat fall together.
    single = rows.where("repeats = 1")
    repeated = rows.where("repeats > 1").dropDuplicates([names[key], "own_hash"])
    return single.unionByName(repeated).select(*(F.col(n).alias(c) for c, n in names.items()))
