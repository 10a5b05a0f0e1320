"""Vector expressions over ``array<float|double>`` columns, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-12


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def normalize(v: Column) -> Column:
    """Scale to unit length, in double."""
    norm = l2_norm(v) + F.lit(EPSILON)
    return F.transform(v, lambda x: x.cast("double") / norm)


def euclidean(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x))


def distance_to_score(distance: Column, metric: str) -> Column:
    """Turn a distance into a score that is larger for closer rows."""
    return F.lit(1.0) - distance if metric == "cosine" else -distance


def threshold_label(score: Column, label: Column, threshold: float | None) -> Column:
    """``label`` where the score reaches the threshold, else -1."""
    if threshold is None:
        return label
    return F.when(score >= F.lit(float(threshold)), label).otherwise(F.lit(-1))
