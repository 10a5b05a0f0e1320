"""Vectors with known neighbours, and plain NumPy answers to compare with."""

from __future__ import annotations

import numpy as np


def planted(groups=6, per_group=20, dim=16, noise=0.05, seed=42):
    """``(ids, groups, unit vectors)``: one random center per group plus noise."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim))
    labels = np.repeat(np.arange(groups), per_group)
    x = centers[labels] + rng.normal(scale=noise, size=(len(labels), dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [f"i{n:04}" for n in range(len(labels))], labels, x.astype(np.float32)


def table(spark, ids, labels, x, partitions=3):
    rows = [(i, f"g{g}", [float(v) for v in row]) for i, g, row in zip(ids, labels, x)]
    schema = "item_id string, group_id string, embedding array<float>"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def brute_force(ids, labels, x, k, metric="cosine", exclude_self=True):
    x = x.astype(np.float64)
    if metric == "cosine":
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        s = np.array([[round(float(a @ b), 9) for b in x] for a in x])
    else:
        s = np.array([[round(-float(np.linalg.norm(a - b)), 9) for b in x] for a in x])
    out = []
    for i, q in enumerate(ids):
        order = sorted((-s[i, j], c, j) for j, c in enumerate(ids) if not (exclude_self and c == q))
        for rank, (score, c, j) in enumerate(order[:k], 1):
            out.append((q, c, f"g{labels[j]}", round(float(-score), 6) + 0.0, rank))
    return sorted(out)
