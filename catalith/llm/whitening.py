"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it. A block
of ``components + GUARD`` directions Q is multiplied by the covariance in passes
over the vectors: each task adds up ``Xᵀ(XQ)`` of its centred rows and emits one
row per dimension, which Spark sums. A round applies a Chebyshev polynomial of
``DEGREE`` to the block, one pass per degree. The polynomial is small on the
interval from 0 to the least Ritz value of the block, so the unwanted part of the
spectrum is damped and the rest grows. Then follow QR and Rayleigh-Ritz, whose
pass also gives the residuals ``|Vq - tq|``. The rounds end when each wanted
residual is certified below ``TOLERANCE`` of the largest eigenvalue.

The driver holds the block and small matrices: ``dims * (components + GUARD)``
doubles, at most ``MAX_BLOCK``. Nothing that grows with the rows leaves the tasks.

Entries are taken as whole numbers ``floor(1024 * c) + 100000``, so sums and means
are exact and rows are centred as ``(n * x - S) / n`` before any product.

Defined cases: vectors that are null, empty, or hold null or non-finite entries
are dropped, and so are those whose length is not the most frequent one (of equally
frequent lengths, the longer). Rows that repeat count each. An empty table gives no
rows. Directions with less than ``LEAST_SHARE`` of the trace have no whitened form
and are left out, so constant vectors, or a single one, give no rows. Entries of
2**40 or more are an error. Only the id and the vector are read.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.session import materialize

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
GUARD = 24
DEGREE = 10
MAX_ROUNDS = 60
TOLERANCE = 1e-13
# Rounding may keep a residual above TOLERANCE; it is accepted below this once it no longer falls.
FLOOR = 1e-10
LEAST_SHARE = 1e-12
MAX_BLOCK = 1 << 24
LARGEST = 1 << 40
SEED = 12_061


@dataclass(frozen=True)
class Whitening:
    """Eigenvalues by falling size and unit eigenvectors (columns) of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int


def whole_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(row_key, x)``: the vectors that can be used, as whole numbers, all of one length."""
    entry = F.col(vector).cast("array<double>")
    good = F.forall(entry, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    in_range = F.forall(entry, lambda e: F.abs(e) * SCALE < float(LARGEST))
    x = F.transform(entry, lambda e: F.floor(e * float(SCALE)) + F.lit(OFFSET).cast("long"))
    kept = materialize(
        df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False))).select(
            F.col(key).alias("row_key"),
            F.when(in_range, x).otherwise(F.raise_error(F.lit("an entry is too large")).cast("array<bigint>")).alias("x"),
        )
    )
    lengths = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).take(2)
    return kept.where(F.size("x") == lengths[0]["d"]) if len(lengths) > 1 else kept


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    """The whole-number vectors of a batch as a matrix."""
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 0)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S/n`` with an exact numerator."""
    return (x * n - sums) / n


def _total(vectors: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of a matrix per block of rows: tasks add up their blocks, Spark adds up the tasks."""
    number = pa.int64() if kind == "bigint" else pa.float64()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_rows(batch))
                total = part if total is None else total + part
        if total is not None:
            values = pa.array(list(total), pa.list_(number))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values], ["i", "values"])

    parts = vectors.select("x").mapInArrow(partial, f"i int, values array<{kind}>")
    summed = parts.select("i", F.posexplode("values").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = summed.toPandas()
    out = np.zeros((int(found["i"].max()) + 1, int(found["j"].max()) + 1), dtype=np.int64 if kind == "bigint" else float)
    out[found["i"], found["j"]] = found["v"]
    return out


def _filtered(times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, image: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """A scaled Chebyshev polynomial of the covariance, small on ``[low, high]``, applied to ``block``.

    ``image`` is the block times the covariance, known from Rayleigh-Ritz. The
    scale is the polynomial's value at ``top``, so nothing overflows.
    """
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = block, (image - middle * block) * (first / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - middle * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The leading ``components`` eigenpairs of the covariance of ``whole_vectors``; None without rows."""
    n = vectors.count()
    if not n:
        return None
    sums = _total(vectors, lambda x: x.sum(axis=0, keepdims=True), "bigint")[0]
    dims = len(sums)
    size = min(dims, components + GUARD)
    if dims * size > MAX_BLOCK:
        raise ValueError(f"{dims} dimensions by {size} directions do not fit the driver")
    trace = float(_total(vectors, lambda x: (_centred(x, n, sums) ** 2).sum(axis=0, keepdims=True), "double").sum() / n)
    passes = 0

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            rows = _centred(x, n, sums)
            return rows.T @ (rows @ block)

        return _total(vectors, product, "double") / n

    block = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, size)))[0]
    wanted = min(components, size)
    last = np.inf
    for _ in range(MAX_ROUNDS):
        image = times(block)
        ritz, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residuals = np.linalg.norm(image - block * ritz, axis=0)[:wanted]
        worst, top = float(residuals.max()), float(ritz[0])
        settled = size == dims or worst <= TOLERANCE * top or (worst <= FLOOR * top and worst > last / 2)
        if settled or top <= LEAST_SHARE * max(trace, 1e-300):
            usable = ritz[:wanted] > LEAST_SHARE * trace
            return Whitening(n, sums, ritz[:wanted][usable], block[:, :wanted][:, usable], trace, residuals[usable], passes)
        last = worst
        high = max(float(ritz[-1]), LEAST_SHARE * top)
        block = np.linalg.qr(_filtered(times, block, image, 0.0, high, top))[0]
    raise RuntimeError(f"residual {worst} of {top} after {MAX_ROUNDS} rounds")


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[decimal.Decimal]:
    """``sum((n * x - S) ** 2)`` of each row, exact."""
    apart = x * n - sums
    if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] >= 2.0**62:
        apart = apart.astype(object)
    return [decimal.Decimal(int(v)) for v in (apart * apart).sum(axis=1)]


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``(row_key, component, deviation, whitened)``: one row per vector and component, from 1."""
    n, sums = model.n, model.sums
    scaled = model.vectors / np.sqrt(model.values)
    k = scaled.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch)
            white = _centred(x, n, sums) @ scaled
            rows = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key").take(rows),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(_deviations(x, n, sums), pa.decimal128(38, 0)).take(rows),
                    pa.array(white.ravel()),
                ],
                ["row_key", "component", "deviation", "whitened"],
            )

    kind = vectors.schema["row_key"].dataType.simpleString()
    return vectors.select("row_key", "x").mapInArrow(
        project, f"row_key {kind}, component int, deviation decimal(38,0), whitened double"
    )


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened vectors, less the identity."""
    n, sums = model.n, model.sums
    scaled = model.vectors / np.sqrt(model.values)

    def means(x: np.ndarray) -> np.ndarray:
        return (_centred(x, n, sums) @ scaled).sum(axis=0, keepdims=True)

    middle = _total(vectors, means, "double")[0] / n

    def products(x: np.ndarray) -> np.ndarray:
        white = _centred(x, n, sums) @ scaled - middle
        return white.T @ white

    return float(np.abs(_total(vectors, products, "double") / n - np.eye(scaled.shape[1])).max())


def whitening_report(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened vectors with the share of each component and the error of the whole.

    ``deviation`` is a long; it is null where the exact number does not fit one,
    which ``whiten`` gives as a decimal.
    """
    vectors = whole_vectors(df, key, vector)
    model = fit_whitening(vectors, components)
    kind = df.schema[key].dataType.simpleString()
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame(
            [], f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    return whiten(vectors, model).select(
        F.col("row_key").alias(key),
        "component",
        F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(identity_error(vectors, model)).alias("identity_error"),
    )
