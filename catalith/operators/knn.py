"""Nearest neighbours: exact, by bounds on stored cells, and through probed cells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as vector_functions
from ..session import BROADCAST_BYTES, write_shared
from .pairwise import (
    BLOCK_ROWS,
    LEAST_ROWS,
    LEFT_ROW,
    arrow_schema,
    compare_all,
    gathered,
    is_small,
    pairwise,
    same_length,
    stored_blocks,
    tiles,
    to_matrix,
    with_rows,
)

# Scores are compared after rounding to this many digits, so that equal
# vectors tie whatever the order of the sums, and ties go to the smaller id.
SCORE_DIGITS = 9

# Scores that differ by more than this differ after rounding.
_ROUNDED = 2 * 10.0**-SCORE_DIGITS

_PROBE_ROW = "probe_row"
INNER_PRODUCT = ("cosine", "ip", "inner_product")
METRICS = (*INNER_PRODUCT, "l2", "euclidean")
# Pairs that are scored one by one at a time.
_PAIRS = 20_000
# Rows and columns of one matrix of estimates, of 2 MB.
_TILE_ROWS = 256
_TILE_COLUMNS = 2048


def parse_metric(metric: str) -> str:
    """A metric's name in lower case; an unknown name is an error."""
    name = metric.lower()
    if name not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    return name


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; a zero row stays, so its cosine with any row is 0."""
    if not x.size:
        return x
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norms > 0, norms, 1.0)


def _similarity(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    if metric in INNER_PRODUCT:
        return np.round(q @ c.T, SCORE_DIGITS)
    squared = (q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * (q @ c.T)
    return -np.maximum(squared, 0.0)


def _exact_l2(q: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    parts = [
        np.sqrt(((q[rows[i : i + _PAIRS]] - c[cols[i : i + _PAIRS]]) ** 2).sum(1))
        for i in range(0, len(rows), _PAIRS)
    ]
    return np.round(-np.concatenate(parts), SCORE_DIGITS)


def top_columns(q, c, k, metric, blocked=()):
    """The best ``k`` columns of each row as ``(rows, columns, scores)``.

    Columns are in id order, so the smaller column wins a tie. ``blocked``
    holds the column range a row must not take.
    """
    scores = _similarity(q, c, metric)
    for row, (start, stop) in enumerate(blocked):
        scores[row, start:stop] = -np.inf
    k = min(k, scores.shape[1])
    if k == 1 and metric in INNER_PRODUCT:
        rows, cols = np.arange(len(scores)), scores.argmax(axis=1)
        values = scores[rows, cols]
        kept = values > -np.inf
        return rows[kept], cols[kept], values[kept]
    cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    slack = 0.0 if metric in INNER_PRODUCT else 1e-9 * (1.0 + (c * c).sum(1).max())
    rows, cols = np.nonzero((scores >= (cut - slack)[:, None]) & (scores > -np.inf))
    if not len(rows):
        return rows, cols, np.zeros(0)
    values = scores[rows, cols] if metric in INNER_PRODUCT else _exact_l2(q, c, rows, cols)
    order = np.lexsort((cols, -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    first = np.searchsorted(rows, rows, side="left")
    kept = np.arange(len(rows)) - first < k
    return rows[kept], cols[kept], values[kept]


class _Estimate:
    """Scores in single precision, of rows and columns at a length of at most 1.

    For inner products an estimate is the score over both lengths. For ``l2`` it is
    ``2qc - c^2``, which falls as the distance rises. No estimate is off by more than
    ``error``, so a pair below the least score that still counts is never one of the best.
    """

    def __init__(self, q: np.ndarray, c: np.ndarray, metric: str):
        self.inner = metric in INNER_PRODUCT
        lengths, most = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1).max()
        if self.inner:
            self.q_scale = np.where(lengths > 0, lengths, 1.0)
            self.c_scale = most or 1.0
        else:
            self.c_scale = max(lengths.max(), most) or 1.0
            self.q_scale = np.full(len(q), self.c_scale)
        q, c = q / self.q_scale[:, None], c / self.c_scale
        self.squares = (q * q).sum(1)
        if not self.inner:
            q = np.column_stack([2.0 * q, np.ones(len(q))])
            c = np.column_stack([c, -(c * c).sum(1)])
        self.error = 8.0 * (q.shape[1] + 4) * 2.0**-24
        self.q, self.c = q.astype(np.float32), np.ascontiguousarray(c.T.astype(np.float32))

    def least(self, rows: slice, scores: np.ndarray) -> np.ndarray:
        """The estimates below which a pair has less than ``scores``, which are rounded."""
        if self.inner:
            found = (scores - _ROUNDED) / (self.q_scale[rows] * self.c_scale)
        else:
            found = self.squares[rows] - ((_ROUNDED - scores) / self.c_scale) ** 2
        return (found - self.error).astype(np.float32)

    def below(self, rows: np.ndarray, estimates: np.ndarray) -> np.ndarray:
        """The estimates below which a pair has a smaller score than one of ``estimates``."""
        found = estimates.astype(np.float64) - self.error
        if self.inner:
            found -= _ROUNDED / (self.q_scale[rows] * self.c_scale)
        else:
            gaps = np.sqrt(np.maximum(self.squares[rows] - found, 0.0)) + _ROUNDED / self.c_scale
            found = self.squares[rows] - gaps**2
        return (found - self.error).astype(np.float32)


def _exact_scores(q, c, rows, cols, metric: str) -> np.ndarray:
    if metric not in INNER_PRODUCT:
        return _exact_l2(q, c, rows, cols) if len(rows) else np.zeros(0)
    parts = [
        np.einsum("ij,ij->i", q[rows[i : i + _PAIRS]], c[cols[i : i + _PAIRS]]) for i in range(0, len(rows), _PAIRS)
    ]
    return np.round(np.concatenate(parts), SCORE_DIGITS) if parts else np.zeros(0)


def best_columns(q, c, k, metric, blocked=(), least=None):
    """What :func:`top_columns` gives, for tables of any size, in tiles that stay in the cache.

    Single precision tells which pairs can be among the best of a row; these alone are
    scored in double precision. ``least`` holds the score of each row below which
    nothing counts, such as its k-th best in other columns.
    """
    k = min(k, len(c))
    if not (np.isfinite(q).all() and np.isfinite(c).all()):
        parts = [(start, top_columns(q[start:stop], c, k, metric, blocked[start:stop])) for start, stop in tiles(len(q), len(c))]
        return tuple(np.concatenate(x) for x in zip(*((rows + start, cols, scores) for start, (rows, cols, scores) in parts)))
    estimate = _Estimate(q, c, metric)
    least = np.full(len(q), -np.inf) if least is None else least
    best = np.full((len(q), k), -np.inf)
    place = np.zeros((len(q), k), dtype=np.int64)
    wide = max(_TILE_COLUMNS, k)
    # One piece of memory for all tiles.
    tile = np.empty(_TILE_ROWS * min(wide, len(c)), dtype=np.float32)
    for start in range(0, len(q), _TILE_ROWS):
        rows = slice(start, min(start + _TILE_ROWS, len(q)))
        for first in range(0, len(c), wide):
            last = min(first + wide, len(c))
            scores = tile[: (rows.stop - start) * (last - first)].reshape(rows.stop - start, last - first)
            np.matmul(estimate.q[rows], estimate.c[:, first:last], out=scores)
            if len(blocked):
                ranges = np.clip(blocked[rows], first, last) - first
                for row in np.flatnonzero(ranges[:, 0] < ranges[:, 1]):
                    scores[row, ranges[row, 0] : ranges[row, 1]] = -np.inf
            bound = estimate.least(rows, np.maximum(best[rows, -1], least[rows]))
            new = np.flatnonzero(np.maximum(best[rows, -1], least[rows]) == -np.inf)
            if len(new) and last - first > k:
                # Rows without k hits so far, here or elsewhere, begin with the best estimates of this tile.
                at = last - first - k
                cut = np.partition(scores[new], at, axis=1)[:, at]
                bound[new] = np.maximum(bound[new], estimate.below(new + start, cut))
            # Most rows have no hit once they have found their best, which their largest estimate tells.
            largest = scores.max(axis=1)
            some = np.flatnonzero((largest >= bound) & (largest > -np.inf))
            if not len(some):
                continue
            scores = scores if len(some) == len(scores) else scores[some]
            found = np.flatnonzero((scores >= bound[some, None]).ravel())
            found = found[scores.ravel()[found] > -np.inf]
            at, cols = some[found // (last - first)] + start, found % (last - first) + first
            values = _exact_scores(q, c, at, cols, metric)
            # Later columns lose ties within this table, but may win those with other tables.
            kept = (values >= least[at]) & (values > best[at, -1])
            _keep_best(best, place, at[kept], cols[kept], values[kept])
    rows, ranks = np.nonzero(best > -np.inf)
    return rows, place[rows, ranks], best[rows, ranks]


def _keep_best(best: np.ndarray, place: np.ndarray, rows, cols, values) -> None:
    """Put new hits of rows, which have later columns, among the best so far."""
    if not len(rows):
        return
    k = best.shape[1]
    touched = np.unique(rows)
    rows = np.concatenate([np.repeat(touched, k), rows])
    cols = np.concatenate([place[touched].ravel(), cols])
    values = np.concatenate([best[touched].ravel(), values])
    order = np.lexsort((cols, -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    ranks = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    kept = ranks < k
    best[rows[kept], ranks[kept]] = values[kept]
    place[rows[kept], ranks[kept]] = cols[kept]


@dataclass(frozen=True)
class TopK:
    """Kernel that keeps the best ``k`` right rows of each left row.

    ``carried`` columns of the left row come with each of its hits. The metric
    ``cosine`` divides by the lengths of the vectors.
    """

    k: int
    metric: str
    exclude_self: bool
    carried: tuple[str, ...] = ("query_id",)
    vector: str = "query_vector"

    def _rows(self, vectors) -> np.ndarray:
        found = to_matrix(vectors)
        return unit_rows(found) if self.metric == "cosine" else found

    def prepare(self, right: pa.Table):
        right = right.sort_by([("candidate_id", "ascending"), ("candidate_group", "ascending")])
        return right["candidate_id"].combine_chunks(), right["candidate_group"].combine_chunks(), self._rows(right["candidate_vector"])

    def compare(self, left: pa.Table, prepared, so_far: pa.Table | None = None) -> pa.Table:
        ids, groups, c = prepared
        q = self._rows(left[self.vector])
        rows, cols, scores = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        same_length(q, c)
        if len(ids) and len(q):
            blocked = self._own_columns(left["query_id"].combine_chunks(), ids) if self.exclude_self else ()
            rows, cols, scores = best_columns(q, c, self.k, self.metric, blocked, self._least(left, so_far))
        kept = left.select([LEFT_ROW, *self.carried]).take(pa.array(rows))
        return pa.table(
            {
                **dict(zip(kept.column_names, kept.columns, strict=True)),
                "candidate_id": ids.take(pa.array(cols)),
                "candidate_group": groups.take(pa.array(cols)),
                "score": pa.array(scores),
                "rank": pa.array(_positions(rows), pa.int32()),
            }
        )

    def _least(self, left: pa.Table, so_far: pa.Table | None) -> np.ndarray | None:
        """The k-th best score so far of each row, below which nothing counts."""
        if so_far is None:
            return None
        last = so_far.filter(pc.equal(so_far["rank"], self.k))
        places, rows = left[LEFT_ROW].to_numpy(), last[LEFT_ROW].to_numpy()
        out = np.full(len(places), -np.inf)
        if len(rows):
            order = np.argsort(rows)
            at = order[np.minimum(np.searchsorted(rows[order], places), len(rows) - 1)]
            out = np.where(rows[at] == places, last["score"].to_numpy()[at], out)
        return out

    def _own_columns(self, query_ids: pa.Array, ids: pa.Array):
        # Nulls are last, and a query without an id excludes nothing.
        ordered = ids.slice(0, len(ids) - ids.null_count).to_numpy(zero_copy_only=False)
        known = query_ids.is_valid().to_numpy(zero_copy_only=False)
        wanted = query_ids.drop_null().to_numpy(zero_copy_only=False)
        out = np.zeros((len(query_ids), 2), int)
        out[known, 0] = np.searchsorted(ordered, wanted, side="left")
        out[known, 1] = np.searchsorted(ordered, wanted, side="right")
        return out

    def merge(self, partial: pa.Table) -> pa.Table:
        ordered = partial.sort_by(
            [(LEFT_ROW, "ascending"), ("score", "descending"), ("candidate_id", "ascending"), ("candidate_group", "ascending")]
        )
        rank = _positions(ordered[LEFT_ROW].to_numpy())
        ordered = ordered.drop_columns("rank").append_column("rank", pa.array(rank, pa.int32()))
        return ordered.filter(pc.less_equal(ordered["rank"], self.k))


def _positions(sorted_groups: np.ndarray) -> np.ndarray:
    """1-based position of each entry within its run of equal values."""
    if not len(sorted_groups):
        return np.zeros(0, int)
    starts = np.flatnonzero(np.r_[True, sorted_groups[1:] != sorted_groups[:-1]])
    lengths = np.diff(np.r_[starts, len(sorted_groups)])
    return np.arange(len(sorted_groups)) - np.repeat(starts, lengths) + 1


def rank_top_k(scored: DataFrame, k: int) -> DataFrame:
    """Keep and rank the best ``k`` candidates of each query.

    Each task drops all but its own best ``k`` before the shuffle.
    """
    order = Window.partitionBy(LEFT_ROW).orderBy(
        F.desc("score"), F.asc_nulls_last("candidate_id"), F.asc_nulls_last("candidate_group")
    )
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def _hit_schema(left: DataFrame, carried, candidates: DataFrame) -> T.StructType:
    return T.StructType(
        [
            *(left.schema[c] for c in carried),
            T.StructField("candidate_id", _type(candidates, "candidate_id")),
            T.StructField("candidate_group", _type(candidates, "candidate_group")),
            T.StructField("score", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ]
    )


def _candidates(catalog, id_column, group_column, vector_column, *others):
    return catalog.select(
        F.col(id_column).alias("candidate_id"),
        F.col(group_column).alias("candidate_group"),
        F.col(vector_column).alias("candidate_vector"),
        *others,
    )


def _queries(queries, id_column, vector_column, carry):
    return queries.select(F.col(id_column).alias("query_id"), F.col(vector_column).alias("query_vector"), *carry)


def nearest(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    exclude_self: bool = False,
    id_column: str = "item_id",
    group_column: str = "group_id",
    vector_column: str = "embedding",
    plan: str = "auto",
    carry: tuple[str, ...] = (),
    **limits,
) -> DataFrame:
    """The ``k`` nearest catalogue rows of each query row, exactly.

    Returns ``(query_id, *carry, candidate_id, candidate_group, score, rank)``;
    ``carry`` names further columns of the queries. A larger score is closer for
    every metric: the cosine, the inner product for ``ip``, the negative distance
    for ``l2``. Queries with fewer than ``k`` candidates get what there is. With
    ``exclude_self`` a candidate with the id of the query does not count. Each
    query row is answered for itself, also if its id is null or repeated. Neither
    table is written unless both exceed the broadcast limit. See :mod:`.pairwise`
    for ``plan`` and ``limits``.
    """
    q = _queries(queries, id_column, vector_column, carry)
    c = _candidates(catalog, id_column, group_column, vector_column)
    kernel = TopK(k, parse_metric(metric), exclude_self, ("query_id", *carry))
    schema = _hit_schema(q, kernel.carried, c)
    out, partial = pairwise(q, c, kernel, schema, "query_vector", "candidate_vector", plan, **limits)
    return rank_top_k(out, k).drop(LEFT_ROW) if partial else out


def attach_nearest(
    rows: DataFrame,
    centers: DataFrame,
    n: int = 1,
    metric: str = "cosine",
    center_id: str = "cluster_id",
    center_vector: str = "centroid",
    id_column: str = "item_id",
    vector_column: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each row with its ``n`` best centers: all its columns, ``center_id``,
    ``score`` and ``rank``. Ties go to the smaller center id.

    Rows stay where they are: while the centers fit the broadcast limit they are
    sent to the tasks, beyond it they are written once and read in blocks. For
    ``cosine`` rows and centers are of length 1, as the operators make them.
    """
    c = centers.select(
        F.col(center_id).alias("candidate_id"),
        F.lit(None).cast("int").alias("candidate_group"),
        F.col(center_vector).alias("candidate_vector"),
    )
    kernel = TopK(n, "ip" if parse_metric(metric) == "cosine" else metric.lower(), False, tuple(rows.columns), vector_column)
    plan = "right" if is_small(c, "candidate_vector", broadcast_bytes) else "blocks"
    hits, _ = pairwise(
        rows, c, kernel, _hit_schema(rows, rows.columns, c), vector_column, "candidate_vector", plan,
        broadcast_bytes=broadcast_bytes, block_rows=block_rows,
    )
    return hits.select(*rows.columns, F.col("candidate_id").alias(center_id), "score", "rank")


def assign_cells(
    rows: DataFrame, cells: DataFrame, n: int = 1, metric: str = "cosine", **columns
) -> DataFrame:
    """``rows`` repeated for each of their ``n`` best cells, with ``cell_id``.

    ``cells`` is ``(cell_id, centroid)``.
    """
    hits = attach_nearest(rows, cells, n, metric, center_id="cell_id", **columns)
    return hits.drop("score", "rank")


def _cell_blocks(members: str, cell, columns: list[str], rows: int) -> Iterator[pa.Table]:
    """The rows of one stored cell, read from its own folder; none if it has no member."""
    folder = f"{members}/cell_id={cell}"
    system, name = fs.FileSystem.from_uri(folder)
    if system.get_file_info(name).type == fs.FileType.NotFound:
        return iter(())
    return stored_blocks(folder, columns, rows)


@dataclass(frozen=True)
class _Names:
    """The columns of a stored catalogue."""

    id_column: str = "item_id"
    group_column: str = "group_id"
    vector_column: str = "embedding"

    def columns(self) -> list[str]:
        return [self.id_column, self.group_column, self.vector_column]

    def candidates(self, table: pa.Table) -> pa.Table:
        found = table.select(self.columns()).rename_columns(["candidate_id", "candidate_group", "candidate_vector"])
        return found.filter(pc.is_valid(found["candidate_vector"]))


def _search_few(probed: pa.Table, catalog: DataFrame, kernel: TopK, schema, block_rows) -> DataFrame:
    """Few queries: they go to the tasks that scan the probed cells, which Spark prunes by partition."""
    cells = sorted(set(probed["cell_id"].to_pylist()))
    shared = catalog.sparkSession.sparkContext.broadcast(
        {cell: probed.filter(pc.equal(probed["cell_id"], cell)) for cell in cells}
    )
    schema = T.StructType([T.StructField(LEFT_ROW, T.LongType()), *schema.fields])
    names = schema.names

    def run(batches):
        partial = None
        for block in gathered(batches, block_rows):
            for cell in pc.unique(block["cell_id"]).to_pylist():
                members = block.filter(pc.equal(block["cell_id"], cell))
                out = kernel.compare(shared.value[cell], kernel.prepare(members), partial).select(names)
                partial = out if partial is None else kernel.merge(pa.concat_tables([partial, out])).select(names)
        if partial is not None:
            yield from partial.to_batches()

    return catalog.where(F.col("cell_id").isin(cells)).mapInArrow(run, schema)


def _search_many(probed: DataFrame, members: str, kernel: TopK, schema, names: _Names, block_rows) -> DataFrame:
    """Many queries: each goes once to every cell it probes, and the task there reads the cell's files."""
    sizes = probed.groupBy(F.col("cell_id").alias("of")).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    split = probed.join(sizes, F.col("cell_id") == F.col("of")).withColumn(
        "block", F.pmod(F.xxhash64(LEFT_ROW), F.col("blocks"))
    )
    schema = T.StructType([T.StructField(LEFT_ROW, T.LongType()), *schema.fields])

    def run(group: pa.Table) -> pa.Table:
        cell = group["cell_id"][0].as_py()
        blocks = map(names.candidates, _cell_blocks(members, cell, names.columns(), block_rows))
        found = compare_all(kernel, group, blocks)
        return empty if found is None else found.select(empty.column_names)

    empty = arrow_schema(schema).empty_table()
    return split.drop("of", "blocks").groupBy("cell_id", "block").applyInArrow(run, schema)


def nearest_in_cells(
    queries: DataFrame,
    catalog_cells: DataFrame,
    cells: DataFrame,
    k: int = 5,
    nprobe: int = 8,
    metric: str = "cosine",
    exclude_self: bool = False,
    id_column: str = "item_id",
    group_column: str = "group_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    stored: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The ``k`` nearest rows among the ``nprobe`` best cells of each query.

    ``catalog_cells`` carries a ``cell_id``. With ``nprobe`` equal to the number of
    cells the result is exact. Queries that fit the broadcast limit, once per probed
    cell, are sent to the scan of the catalogue; read from ``write_cells``, only the
    folders of the probed cells are scanned, and nothing of the catalogue is written
    or shuffled. More queries are dealt to the cells they probe, and tasks read a
    cell's files from ``stored``, the folder of ``write_cells``; without it the
    catalogue is written by cells once.
    """
    block_rows = max(block_rows, LEAST_ROWS)
    # A row keeps its number in all the cells it probes.
    numbered_queries = queries.withColumn(_PROBE_ROW, F.monotonically_increasing_id())
    q = _queries(numbered_queries, id_column, vector_column, (_PROBE_ROW, *carry))
    few = is_small(q, "query_vector", broadcast_bytes // max(1, nprobe))
    kernel = TopK(k, parse_metric(metric), exclude_self, ("query_id", *carry))
    c = _candidates(catalog_cells, id_column, group_column, vector_column, "cell_id")
    schema = _hit_schema(q, kernel.carried, c)
    probed = assign_cells(q, cells, nprobe, metric, id_column="query_id", vector_column="query_vector")
    probed = probed.withColumnRenamed(_PROBE_ROW, LEFT_ROW)
    if few:
        found = _search_few(probed.toArrow(), c.where("candidate_vector is not null"), kernel, schema, block_rows)
    else:
        if stored is None:
            thin = catalog_cells.select(id_column, group_column, vector_column, "cell_id")
            members = write_shared(thin.hint("rebalance", "cell_id"), ["cell_id"])
        else:
            members = f"{stored}/members"
        names = _Names(id_column, group_column, vector_column)
        found = _search_many(probed, members, kernel, schema, names, block_rows)
    return rank_top_k(found, k).drop(LEFT_ROW)


def cell_radii(
    catalog_cells: DataFrame, cells: DataFrame, metric: str = "cosine", vector_column: str = "embedding"
) -> DataFrame:
    """``(cell_id, centroid, radius, n)``: the largest distance of a member from the centroid.

    For ``cosine`` members are taken at length 1. A cell without members is left out.
    """
    vector = F.col(vector_column).cast("array<double>")
    if parse_metric(metric) == "cosine":
        vector = vector_functions.normalize(vector)
    few = is_small(cells.select("cell_id", "centroid"), "centroid")
    centers = F.broadcast(cells.select("cell_id", "centroid")) if few else cells.select("cell_id", "centroid")
    gaps = catalog_cells.where(F.col(vector_column).isNotNull()).join(centers, "cell_id").select(
        "cell_id", vector_functions.euclidean(vector, F.col("centroid")).alias("gap")
    )
    found = gaps.groupBy("cell_id").agg(F.max("gap").alias("radius"), F.count(F.lit(1)).alias("n"))
    return cells.select("cell_id", "centroid").join(found, "cell_id")


# Added to a bound, so that rounding never rules out a cell that holds a tie.
_SLACK = 1e-6


def nearest_by_bounds(
    queries: DataFrame,
    stored: str,
    radii: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    exclude_self: bool = False,
    id_column: str = "item_id",
    group_column: str = "group_id",
    vector_column: str = "embedding",
    block_rows: int = 4096,
    broadcast_bytes: int = BROADCAST_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The ``k`` nearest catalogue rows of each query row, exactly, by bounds on cells.

    ``stored`` is the folder of ``write_cells`` and ``radii`` comes from
    :func:`cell_radii`. By the triangle inequality no member of a cell is closer to a
    query than the distance of the centroid less the radius. A query looks into its
    closest cells until ``k`` rows are found, and then only into cells whose bound is
    within its k-th distance; the others are not read. Besides the columns of
    :func:`nearest` there is ``compared``, the candidates the query was compared
    with. Queries stay where they are; nothing is shuffled. For ``cosine`` and ``l2``.
    """
    metric = parse_metric(metric)
    if metric in ("ip", "inner_product"):
        raise ValueError("inner products have no triangle inequality")
    block_rows = max(block_rows, LEAST_ROWS)
    centers = radii.select("cell_id", "centroid", "radius", "n")
    if not is_small(centers, "centroid", broadcast_bytes):
        raise ValueError(f"the centroids exceed the broadcast limit of {broadcast_bytes} bytes")
    table = centers.toArrow()
    shared = queries.sparkSession.sparkContext.broadcast(
        (table["cell_id"].to_pylist(), to_matrix(table["centroid"]), table["radius"].to_numpy())
    )
    q = _queries(queries, id_column, vector_column, carry).where("query_vector is not null")
    c = queries.sparkSession.read.parquet(f"{stored}/members")
    kernel = TopK(k, metric, exclude_self, ("query_id", *carry))
    names = _Names(id_column, group_column, vector_column)
    schema = _hit_schema(q, kernel.carried, _candidates(c, id_column, group_column, vector_column))
    schema = T.StructType([*schema.fields, T.StructField("compared", T.LongType())])
    members = f"{stored}/members"

    def run(batches):
        ids, centroids, reach = shared.value
        for block in gathered(batches, block_rows):
            if not len(ids):
                continue
            left = with_rows(block)
            x = kernel._rows(left["query_vector"])
            same_length(x, centroids)
            gaps = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (centroids * centroids).sum(1) - 2 * x @ centroids.T, 0.0))
            bounds = np.maximum(gaps - reach, 0.0)
            kth = np.full(len(x), np.inf)
            compared = np.zeros(len(x), dtype=np.int64)
            found = None
            # The cells that are closest to most queries come first, so that bounds are tight early.
            for j in np.argsort(bounds.min(axis=0) + gaps.min(axis=0), kind="stable"):
                near = np.flatnonzero(bounds[:, j] <= kth + _SLACK * (1 + np.where(np.isinf(kth), 0, kth)))
                if not len(near):
                    continue
                some = left.take(pa.array(near))
                for candidates in map(names.candidates, _cell_blocks(members, ids[j], names.columns(), BLOCK_ROWS)):
                    out = kernel.compare(some, kernel.prepare(candidates), found)
                    compared[near] += len(candidates)
                    found = out if found is None else kernel.merge(pa.concat_tables([found, out]))
                if found is not None:
                    last = found.filter(pc.equal(found["rank"], k))
                    scores = last["score"].to_numpy()
                    distance = -scores if metric not in INNER_PRODUCT else np.sqrt(np.maximum(2.0 - 2.0 * scores, 0.0))
                    kth[last[LEFT_ROW].to_numpy()] = distance
            if found is not None:
                counts = pa.array(compared[found[LEFT_ROW].to_numpy()])
                yield from found.append_column("compared", counts).select(schema.names).to_batches()

    return q.mapInArrow(run, schema)


def nearest_pairs(catalog: DataFrame, metric: str = "cosine", **options) -> DataFrame:
    """Each item with its nearest other item and both groups."""
    group_column = options.get("group_column", "group_id")
    rows = catalog.withColumn("query_group", F.col(group_column))
    best = nearest(rows, catalog, 1, metric, exclude_self=True, carry=("query_group",), **options)
    return best.select(
        F.col("query_id").alias("item_id"),
        F.col("query_group").alias("group_id"),
        F.col("candidate_id").alias("nearest_id"),
        F.col("candidate_group").alias("nearest_group"),
        "score",
    )
