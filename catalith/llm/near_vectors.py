"""Near-duplicate vectors by product quantisation.

Equal vectors of a label are one class. Centroids of coarse lists and codebooks
of the residuals' subspaces are fitted on at most ``SAMPLE`` classes, taken by
hash; every class is indexed. A class goes to its nearest list with one code per
subspace and the length of what the codes leave out.

Every class is also a query. It probes each list that a partner can be in: with
unit vectors at cosine ``c`` the distance is at most ``r = sqrt(2 - 2c)``, a
partner in list ``l`` is nearer to ``l`` than to the query's own list, and so the
query lies within ``r`` of the plane between the two centroids. In a list, sums
of table lookups by code give the distance to the coded vector; a class is a
candidate if that is at most ``r`` plus what its code leaves out. Neither test
loses a pair, so each pair is tried once, with one of the two as the query.
Candidates are compared by the exact cosine in double precision.

A label of few classes is searched by one task. The classes of others are written
once, in blocks of neighbouring lists; a task reads two blocks and probes the lists of
one with the classes of the other, so no class is copied for the lists it probes.
Tasks return numbers of links per class and a spanning forest of the links, never the
links, so the output grows with the number of classes and blocks.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
parts, and vectors without a label, link with nothing. Vectors of different
lengths link with nothing, as they are of different groups. Rows that repeat are
vectors of their own. A null id is never the least id of a component unless all
ids in it are null. An empty table gives no rows. Only id, vector and label are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.llm.graph import components
from catalith.llm.near_text import by_group, merge, whole_groups
from catalith.operators.pairwise import stored_table
from catalith.session import materialize, write_shared

#: Classes on which centroids and codebooks are fitted; no more than this many reach the driver.
SAMPLE = 20_000
LIST_ROWS = 4096
MAX_LISTS = 2048
SUBSPACES = 8
CODES = 64
ROUNDS = 8
#: Classes of a block, and of a label that one task searches.
BLOCK = 4096
#: Most rows of sizes that are broadcast.
FEW_LISTS = 100_000
#: Numbers of a matrix of coded distances.
TILE = 1 << 20
PAIRS = 8192


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    half = (centroids * centroids).sum(axis=1) / 2
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = (half - x[i : i + 4096] @ centroids.T).argmin(axis=1)
    return out


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids after some rounds of Lloyd's method; an empty one keeps its place."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centroids)
        counts = np.bincount(near, minlength=len(centroids))
        for part in range(x.shape[1]):
            sums = np.bincount(near, weights=x[:, part], minlength=len(centroids))
            np.divide(sums, counts, out=centroids[:, part], where=counts > 0)
    return centroids


class Quantizer:
    """Coarse centroids and, for each subspace of the residuals, a codebook."""

    def __init__(self, x: np.ndarray, lists: int):
        self.centroids = _kmeans(x, lists, 1)
        residuals = x - self.centroids[_nearest(x, self.centroids)]
        edges = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int)
        self.parts = list(zip(edges[:-1], edges[1:], strict=True))
        self.books = [_kmeans(residuals[:, a:b], CODES, 2 + i) for i, (a, b) in enumerate(self.parts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The list, the codes and the length left out, of each row."""
        own = _nearest(x, self.centroids)
        residuals = x - self.centroids[own]
        codes = np.empty((len(x), len(self.parts)), dtype=np.uint8)
        for i, (a, b) in enumerate(self.parts):
            codes[:, i] = _nearest(residuals[:, a:b], self.books[i])
            residuals[:, a:b] -= self.books[i][codes[:, i]]
        return own, codes, np.sqrt((residuals * residuals).sum(axis=1))

    def near(self, x: np.ndarray, own: np.ndarray, coarse: int, radius: float) -> np.ndarray:
        """The rows that must probe a list: a vector in it may be within ``radius``."""
        c, center = self.centroids, self.centroids[coarse]
        squares = (c * c).sum(axis=1)
        between = np.sqrt(np.maximum(squares + squares[coarse] - 2 * c @ center, 0))
        mine = c[own]
        gap = (squares[coarse] - 2 * x @ center) - (squares[own] - 2 * np.einsum("ij,ij->i", x, mine))
        return np.flatnonzero((own == coarse) | (gap <= 2 * radius * between[own] + 1e-9))

    def tables(self, x: np.ndarray, coarse: int) -> list[np.ndarray]:
        """For each subspace, squared distances from the rows' residuals to all codes."""
        residuals = x - self.centroids[coarse]
        found = []
        for (a, b), book in zip(self.parts, self.books, strict=True):
            part = residuals[:, a:b]
            found.append(
                ((part * part).sum(axis=1)[:, None] + (book * book).sum(axis=1) - 2 * part @ book.T).astype(np.float32)
            )
        return found


def _rows(column: pa.Array) -> np.ndarray:
    """The vectors of one dimension as they came, in single or double precision."""
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # The largest part is taken out first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _nearest_lists(quantizers: dict[int, Quantizer]):
    """The list of each class, for the sizes of lists."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows in _widths(batch):
                own = _nearest(_units(_rows(rows.column("vector"))), quantizers[width].centroids)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("label"), rows.column("dims"), pa.array(own)], ["label", "dims", "list"]
                )

    return lists


def _widths(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch for each dimension."""
    dims = batch.column("dims").to_numpy()
    for width in np.unique(dims):
        yield int(width), batch.take(pa.array(np.flatnonzero(dims == width)))


def _index(quantizers: dict[int, Quantizer]):
    """Classes with their list, codes and the length that these leave out."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows in _widths(batch):
                raw = _rows(rows.column("vector"))
                own, codes, rest = quantizers[width].encode(_units(raw))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("label"),
                        rows.column("dims"),
                        pa.array(own),
                        rows.column("class"),
                        rows.column("copies"),
                        pa.array([v.tobytes() for v in raw], pa.binary()),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(rest),
                    ],
                    ["label", "dims", "list", "class", "copies", "raw", "codes", "rest"],
                )

    return index


INDEXED = "label string, dims int, list long, class long, copies long, raw binary, codes binary, rest double"
FOUND = "class long, partners long, root long"
STORED = ["dims", "list", "class", "copies", "raw", "codes", "rest"]
PAIR = ["a_home", "a_part", "b_home", "b_part"]


class _Block:
    """Indexed classes of one label and dimension, in the order of their lists."""

    def __init__(self, table: pa.Table):
        table = table.take(pa.array(np.argsort(table.column("list").to_numpy(), kind="stable")))
        n, self.width = table.num_rows, table.column("dims")[0].as_py()
        self.lists, self.cls, self.copies = (table.column(c).to_numpy() for c in ("list", "class", "copies"))
        self.rest = table.column("rest").to_numpy().astype(np.float32)
        raw = b"".join(table.column("raw").to_pylist())
        precision = np.float32 if len(raw) == 4 * self.width * n else np.float64
        self.unit = _units(np.frombuffer(raw, dtype=precision).reshape(n, self.width))
        self.codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=np.uint8).reshape(n, -1)
        self.starts = np.flatnonzero(np.append(True, self.lists[1:] != self.lists[:-1]))


def _columns(found: tuple | None) -> Iterator[pa.RecordBatch]:
    if found is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["class", "partners", "root"])


def _search(quantizers: dict[int, Quantizer], cosine: float):
    """Links within whole labels."""
    keys = ["label", "dims"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            columns = [table.column(k).to_numpy() for k in keys]
            first = np.ones(table.num_rows, dtype=bool)
            first[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            starts = np.flatnonzero(first)
            for start, end in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
                if end - start > 1:
                    block = _Block(table.slice(int(start), int(end - start)))
                    yield from _columns(_links(block, block, quantizers, cosine))

    return search


def _search_pairs(path: str, quantizers: dict[int, Quantizer], cosine: float):
    """Links between two stored blocks, or within one."""

    def load(home: int, part: int) -> _Block | None:
        table = stored_table(f"{path}/home={home}/part={part}", STORED)
        return None if table is None else _Block(table)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            for a_home, a_part, b_home, b_part in zip(*(batch.column(c).to_pylist() for c in PAIR), strict=True):
                if held != (a_home, a_part):
                    held, block = (a_home, a_part), load(a_home, a_part)
                other = block if held == (b_home, b_part) else load(b_home, b_part)
                # A part to which no class was dealt has no folder.
                if block is not None and other is not None:
                    yield from _columns(_links(block, other, quantizers, cosine))

    return search


def _links(a: _Block, b: _Block, quantizers: dict[int, Quantizer], cosine: float):
    """Partners of the classes of two blocks, or of one, among each other, and a forest of the links."""
    quantizer, radius = quantizers[a.width], math.sqrt(2 - 2 * cosine)
    bound = (np.float32(radius) + b.rest) ** 2 + np.float32(1e-4)
    # Places of the classes of ``b`` come after those of ``a``.
    after = 0 if a is b else len(a.cls)
    partners = np.zeros(after + len(b.cls), dtype=np.int64)
    label = np.arange(len(partners))
    for start, end in zip(b.starts, np.append(b.starts[1:], len(b.cls)), strict=True):
        coarse = int(b.lists[start])
        # Within a block each pair is tried with the earlier class as the query.
        asking = slice(0, end if a is b else len(a.cls))
        queries = quantizer.near(a.unit[asking], a.lists[asking], coarse, radius)
        size = max(1, TILE // (end - start))
        for begin in range(0, len(queries), size):
            strip = queries[begin : begin + size]
            distance = np.zeros((len(strip), end - start), dtype=np.float32)
            for part, lookup in enumerate(quantizer.tables(a.unit[strip], coarse)):
                distance += lookup[:, b.codes[start:end, part]]
            row, column = np.nonzero(distance <= bound[start:end])
            row, column = strip[row], column + start
            if a is b:
                once = row < column
                row, column = row[once], column[once]
            exact = np.zeros(len(row), dtype=bool)
            for i in range(0, len(row), PAIRS):
                x, y = a.unit[row[i : i + PAIRS]], b.unit[column[i : i + PAIRS]]
                exact[i : i + PAIRS] = np.einsum("ij,ij->i", x, y) >= cosine
            row, column = row[exact], column[exact]
            if len(row):
                np.add.at(partners, row, b.copies[column])
                np.add.at(partners, column + after, a.copies[row])
                label = merge(label, row, column + after)
    ids = a.cls if a is b else np.concatenate((a.cls, b.cls))
    some = np.flatnonzero(partners)
    if not len(some):
        return None
    joined = np.flatnonzero(label != np.arange(len(label)))
    return (
        np.concatenate((ids[some], ids[joined])),
        np.concatenate((partners[some], np.zeros(len(joined), dtype=np.int64))),
        np.concatenate((ids[some], ids[label[joined]])),
    )


def _stored_blocks(classes: DataFrame, lists, index) -> tuple[str, DataFrame]:
    """The folder of the blocks of large labels, and ``(label, dims, home, part)`` of each block.

    ``home`` numbers neighbouring lists of one label; a list of more than ``BLOCK`` classes
    is dealt to several parts. Vectors are not written before they are dealt, so lists are
    found twice; a class that came to another list the second time goes to the first block.
    """
    keys = ["label", "dims"]
    sizes = classes.mapInArrow(lists, "label string, dims int, list long").groupBy(*keys, "list").count()
    numbered = materialize(sizes.withColumn("at", F.monotonically_increasing_id()))
    before = F.sum("count").over(Window.partitionBy(*keys).orderBy("list")) - F.col("count")
    shared = Window.partitionBy(*keys, "bucket")
    places = materialize(
        numbered.withColumn("bucket", F.floor(before / BLOCK))
        .withColumns({"home": F.min("at").over(shared), "parts": F.greatest(F.lit(1), F.floor(F.col("count") / BLOCK))})
        .select(*keys, "list", "home", "parts")
    )
    few = places.limit(FEW_LISTS + 1).count() <= FEW_LISTS
    first = places.groupBy(*keys).agg(F.min("home").alias("first"))
    placed = classes.mapInArrow(index, INDEXED).join(F.broadcast(places) if few else places, [*keys, "list"], "left")
    placed = placed.join(F.broadcast(first), keys).withColumns(
        {
            "home": F.coalesce("home", "first"),
            "part": F.coalesce(F.pmod(F.xxhash64("class"), F.col("parts")), F.lit(0)),
        }
    )
    path = write_shared(placed.select(*STORED, "home", "part").repartition("home", "part"), ["home", "part"])
    homes = places.groupBy(*keys, "home").agg(F.max("parts").alias("parts"))
    return path, materialize(homes.select(*keys, "home", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))


def _fit(classes: DataFrame) -> dict[int, Quantizer]:
    """One quantizer per dimension, from a bounded sample; lists grow with the classes."""
    counts = {r["dims"]: r["count"] for r in classes.groupBy("dims").count().collect()}
    fitted = {}
    for width, count in counts.items():
        share = F.lit(min(1.0, SAMPLE / count * 0.9))
        drawn = F.pmod(F.xxhash64("class"), F.lit(1 << 20)) < share * (1 << 20)
        rows = classes.where((F.col("dims") == width) & drawn).select("vector").limit(SAMPLE)
        found = rows.toArrow().column("vector").combine_chunks()
        if not len(found):
            found = classes.where(F.col("dims") == width).select("vector").limit(1).toArrow().column(0).combine_chunks()
        lists = max(1, min(MAX_LISTS, count // LIST_ROWS, len(found) // 8))
        fitted[width] = Quantizer(_units(_rows(found)), lists)
    return fitted


def near_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of every row.

    Rows of one label link where the cosine is at least ``cosine``; ``n_links``
    counts the other rows linked directly, and ``component_id`` is the least id
    that links reach.
    """
    spark = df.sparkSession
    kind = f"array<{'double' if 'double' in df.schema[vector].dataType.simpleString() else 'float'}>"
    rows = df.select(F.col(key).alias("row_key"), F.col(vector).cast(kind).alias("vector"), F.col(label).cast("string").alias("label"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = (F.col("label").isNotNull()) & (F.size("vector") > 0) & fine & F.exists("vector", lambda v: v != 0)
    same = F.when(F.coalesce(good, F.lit(False)), F.unhex(F.md5(F.to_json(F.struct("label", "vector")))))
    keyed = rows.withColumn("same", same)
    classes = materialize(
        keyed.where("same IS NOT NULL")
        .groupBy("same")
        .agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("row_key").alias("least"), F.count("*").alias("copies"))
        .withColumn("dims", F.size("vector"))
        .withColumn("class", F.monotonically_increasing_id())
    )
    shared = spark.sparkContext.broadcast(_fit(classes))

    def lists(batches):
        return _nearest_lists(shared.value)(batches)

    def index(batches):
        return _index(shared.value)(batches)

    def search(batches):
        return _search(shared.value, cosine)(batches)

    def search_pairs(batches):
        return _search_pairs(path, shared.value, cosine)(batches)

    group = ["label", "dims"]
    vectors = classes.select(*group, "class", "copies", "vector")
    large = materialize(classes.groupBy(*group).count().where(F.col("count") > BLOCK).select(*group))
    rest = vectors.join(F.broadcast(large), group, "left_anti").mapInArrow(index, INDEXED)
    parts = [by_group(rest, group, search, FOUND)]
    if large.limit(1).count():
        path, blocks = _stored_blocks(vectors.join(F.broadcast(large), group, "left_semi"), lists, index)
        a, b = (blocks.select(*group, F.col("home").alias(f"{x}_home"), F.col("part").alias(f"{x}_part")) for x in "ab")
        once = (F.col("a_home") < F.col("b_home")) | ((F.col("a_home") == F.col("b_home")) & (F.col("a_part") <= F.col("b_part")))
        pairs = materialize(a.join(b, group).where(once).select(*PAIR))
        tasks = max(4 * spark.sparkContext.defaultParallelism, min(10_000, pairs.count() // 32))
        parts.append(pairs.repartition(tasks).sortWithinPartitions(*PAIR).mapInArrow(search_pairs, FOUND))
    found = materialize(reduce(DataFrame.unionByName, parts))
    partners = found.where("partners > 0").groupBy("class").agg(F.sum("partners").alias("partners"))
    trees = components(found.where("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b")))
    members = materialize(trees.join(classes.select(F.col("class").alias("node"), "least"), "node"))
    least = materialize(members.groupBy("root").agg(F.min("least").alias("component_id")))
    reached = members.join(least, "root").select(F.col("node").alias("class"), "component_id")
    answer = materialize(
        classes.select("class", "same", "least", "copies")
        .join(partners, "class", "left")
        .join(reached, "class", "left")
        .select(
            "same",
            (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    component = F.when(F.col("same").isNull(), F.col("row_key")).otherwise(F.col("component_id"))
    return keyed.drop("label", "vector").join(answer, "same", "left").select(
        F.col("row_key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("row_key").eqNullSafe(component).alias("kept"),
    )

