"""k-means, centroids and assignment of vectors to clusters."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors
from ..session import BROADCAST_BYTES, materialize
from .knn import INNER_PRODUCT, attach_nearest, top_columns
from .pairwise import is_small, tiles, to_matrix

# Largest move of a centroid that counts as none.
TOLERANCE = 1e-4
# The start of a fit by tables: rounds of draws, rows drawn in a round for each center, and
# rounds and steps in which the candidates are clustered.
ROUNDS = 5
OVERSAMPLING = 2
STARTS = 16
RECLUSTER_STEPS = 5
# Most batches of one pass of the mini-batch fit.
PASS_BATCHES = 256
# Share of its length that a centroid may move in the last pass.
SETTLED = 0.01

CENTROIDS = T.StructType(
    [
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("centroid", T.ArrayType(T.DoubleType())),
    ]
)


def _as_vector(column: str):
    return array_to_vector(F.col(column).cast("array<double>"))


def _centroid_table(spark, centers) -> DataFrame:
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(centers)]
    return spark.createDataFrame(rows, CENTROIDS)


def _fit(rows: DataFrame, k: int, seed: int, max_iter: int, metric: str, n_init: int) -> np.ndarray:
    """Centers of the fit of lowest cost out of ``n_init`` starts."""
    # Starts and steps read the written vectors, not what they are made of.
    data = materialize(rows).select(_as_vector(rows.columns[0]).alias("features"))
    models = []
    for i in range(n_init):
        estimator = KMeans(
            k=k, seed=seed + i, maxIter=max_iter, distanceMeasure=metric, initMode="k-means||",
            initSteps=5, featuresCol="features",
        )
        models.append(estimator.fit(data))
    best = min(models, key=lambda model: model.summary.trainingCost)
    return np.array(best.clusterCenters())


def _vectors(catalog: DataFrame, metric: str, vector_column: str) -> DataFrame:
    """The vectors that take part in a fit; a zero vector has no direction for ``cosine``."""
    rows = catalog.where(F.col(vector_column).isNotNull()).select(vector_column)
    if metric == "cosine":
        rows = rows.where(vectors.l2_norm(F.col(vector_column)) > 0)
    if rows.head() is None:
        raise ValueError("no vectors to cluster")
    return rows


def zero_vectors(catalog: DataFrame, vector_column: str = "embedding") -> DataFrame:
    """``(n)``: the rows that a fit by ``cosine`` leaves out."""
    return catalog.agg(F.count_if(vectors.l2_norm(F.col(vector_column)) == 0).alias("n"))


def _fits(rows: DataFrame, k: int, vector_column: str, limit: int) -> bool:
    d = rows.select(F.size(vector_column).alias("d")).head()["d"]
    return k * d * 8 <= limit


def kmeans(
    catalog: DataFrame,
    k: int = 8,
    seed: int = 42,
    max_iter: int = 300,
    metric: str = "cosine",
    n_init: int = 1,
    vector_column: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Centroids ``(cluster_id, centroid)`` of a distributed k-means.

    ``metric`` is ``cosine`` (labels agree with the best cosine) or
    ``euclidean``. For ``cosine`` rows with a zero vector do not take part in
    the fit, see :func:`zero_vectors`. Centroids beyond the broadcast limit stay
    a table from step to step.
    """
    rows = _vectors(catalog, metric, vector_column)
    if _fits(rows, k, vector_column, broadcast_bytes):
        return _centroid_table(catalog.sparkSession, _fit(rows, k, seed, max_iter, metric, n_init))
    return _fit_table(rows, k, seed, max_iter, metric, n_init, vector_column, broadcast_bytes)


def _fit_table(rows, k, seed, max_iter, metric, n_init, vector_column, limit) -> DataFrame:
    """Lloyd's steps with the centroids as a table: the best of ``n_init`` starts.

    A start is that of k-means||, see :func:`_start_table`.
    """
    space = "cosine" if metric == "cosine" else "l2"
    if metric == "cosine":
        rows = rows.select(vectors.normalize(F.col(vector_column)).alias(vector_column))
    rows = materialize(rows.withColumn("item_id", F.monotonically_increasing_id()))
    best = None
    for start in range(n_init):
        centers = _start_table(rows, k, seed + start, space, vector_column, limit)
        for _ in range(max_iter):
            moved = lloyd_step(rows, centers, space, vector_column, limit).select("cluster_id", "centroid")
            if metric == "cosine":
                moved = unit_centroids(moved)
            kept = centers.join(moved.withColumnRenamed("centroid", "moved"), "cluster_id", "left")
            both = materialize(kept.select("cluster_id", "centroid", F.coalesce("moved", "centroid").alias("moved")))
            gap = both.agg(F.max(vectors.euclidean(F.col("centroid"), F.col("moved")))).first()[0]
            centers = both.select("cluster_id", F.col("moved").alias("centroid"))
            if gap <= TOLERANCE:
                break
        hits = attach_nearest(rows, centers, 1, space, vector_column=vector_column, broadcast_bytes=limit)
        quality = hits.agg(F.sum("score")).first()[0]
        if best is None or quality > best[0]:
            best = quality, centers
    return best[1]


def _uniform(seed: int) -> F.Column:
    """A number above 0 and up to 1 for each row, by its id."""
    return (F.shiftrightunsigned(F.xxhash64("item_id", F.lit(seed)), 11) + 1) / float(1 << 53)


def _distances(rows: DataFrame, centers: DataFrame, vector_column: str, limit: int) -> DataFrame:
    """``rows`` with ``squared``, the squared distance to the nearest center, and its id ``cluster_id``."""
    named = centers.select(F.col("item_id").alias("cluster_id"), F.col(vector_column).alias("centroid"))
    hits = attach_nearest(rows, named, 1, "l2", vector_column=vector_column, broadcast_bytes=limit)
    return hits.withColumn("squared", F.col("score") * F.col("score")).drop("score", "rank")


def _start_table(rows, k, seed, space, vector_column, limit) -> DataFrame:
    """``k`` centers by k-means||: far rows are drawn in a few rounds, each row for itself with
    a chance that grows with its squared distance, some ``OVERSAMPLING * k`` a round; each
    candidate then weighs as many rows as are nearest to it, and the weighted candidates,
    a small table, are clustered to ``k``.
    """
    first = rows.orderBy(_uniform(seed)).limit(1).select("item_id", vector_column)
    found = materialize(first)
    for i in range(ROUNDS):
        gaps = materialize(_distances(rows, found, vector_column, limit))
        cost = gaps.agg(F.sum("squared")).first()[0]
        if not cost:
            break
        chance = OVERSAMPLING * k * F.col("squared") / cost
        drawn = gaps.where(_uniform(seed + i + 1) <= chance).select("item_id", vector_column)
        found = materialize(found.unionByName(drawn))
    weights = _distances(rows, found, vector_column, limit).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("weight"))
    weighted = materialize(found.join(weights, F.col("item_id") == F.col("cluster_id")).drop("cluster_id"))
    centers = _spread_centers(weighted, k, seed, vector_column, limit)
    for _ in range(RECLUSTER_STEPS):
        members = _distances(weighted, centers, vector_column, limit)
        total = F.transform(F.col(vector_column).cast("array<double>"), lambda x: x * F.col("weight"))
        sums = members.select("cluster_id", "weight", total.alias("total")).groupBy(F.col("cluster_id").alias("item_id")).agg(
            F.sum("weight").alias("weight"), vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")
        )
        mean = F.transform("total", lambda x: x / F.col("weight"))
        if space == "cosine":
            mean = vectors.normalize(mean)
        centers = materialize(sums.select("item_id", mean.alias(vector_column)))
    place = F.row_number().over(Window.orderBy("item_id")) - 1
    return materialize(
        centers.select(place.cast("int").alias("cluster_id"), F.col(vector_column).cast("array<double>").alias("centroid"))
    )


def _spread_centers(weighted: DataFrame, k: int, seed: int, vector_column: str, limit: int) -> DataFrame:
    """``k`` of the candidates, drawn without return by weight and squared distance in a few rounds."""
    heaviest = weighted.orderBy(F.desc("weight"), "item_id").limit(1)
    centers = materialize(heaviest.select("item_id", vector_column))
    count = 1
    for i in range(STARTS):
        wanted = k - count if i == STARTS - 1 else min(k - count, math.ceil(k / STARTS))
        if wanted <= 0:
            break
        gaps = _distances(weighted, centers, vector_column, limit).where("squared > 0")
        turn = -F.log(_uniform(seed + 100 + i)) / (F.col("squared") * F.col("weight"))
        more = gaps.orderBy(turn).limit(wanted).select("item_id", vector_column)
        centers = materialize(centers.unionByName(more))
        count = centers.count()
    return centers


def _cluster_sums(
    rows: DataFrame, labels: np.ndarray, centers: np.ndarray, metric: str, vector_column: str
) -> DataFrame:
    """``(cluster_id, n, total)``: members and vector sum of each cluster.

    Each task sends one row per cluster it saw.
    """
    shared = rows.sparkSession.sparkContext.broadcast((labels, centers))

    def run(batches):
        labels, c = shared.value
        counts, totals = np.zeros(len(c), int), np.zeros(c.shape)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = to_matrix(batch.column(0))
            for start, stop in tiles(len(q), len(c)):
                _, best, _ = top_columns(q[start:stop], c, 1, metric)
                order = np.argsort(best, kind="stable")
                seen, first = np.unique(best[order], return_index=True)
                totals[seen] += np.add.reduceat(q[start:stop][order], first, axis=0)
                counts += np.bincount(best, minlength=len(c))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(labels[seen], pa.int32()),
                pa.array(counts[seen], pa.int64()),
                pa.array(list(totals[seen]), pa.list_(pa.float64())),
            ],
            names=["cluster_id", "n", "total"],
        )

    vectors_ = rows.where(F.col(vector_column).isNotNull()).select(vector_column)
    sums = vectors_.mapInArrow(run, "cluster_id int, n bigint, total array<double>")
    return sums.groupBy("cluster_id").agg(
        F.sum("n").alias("n"),
        vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"),
    )


def lloyd_step(
    catalog: DataFrame,
    centroids: DataFrame,
    metric: str = "l2",
    vector_column: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One k-means step: ``(cluster_id, n, centroid)`` as means of the members.

    Tasks send one sum per cluster, not the vectors. Clusters that lose all
    members are absent. Centroids beyond the broadcast limit are compared in
    blocks.
    """
    centroids = centroids.select("cluster_id", "centroid")
    if not is_small(centroids, "centroid", broadcast_bytes):
        rows = catalog.where(F.col(vector_column).isNotNull()).select(vector_column)
        hits = attach_nearest(
            rows.withColumn("item_id", F.lit(None).cast("long")), centroids, 1, metric,
            vector_column=vector_column, broadcast_bytes=broadcast_bytes,
        )
        return cluster_means(hits, vector_column=vector_column)
    table = centroids.select("cluster_id", "centroid").toArrow().sort_by("cluster_id")
    labels, centers = table["cluster_id"].to_numpy(), to_matrix(table["centroid"])
    sums = _cluster_sums(catalog, labels, centers, metric, vector_column)
    mean = F.transform("total", lambda x: x / F.col("n"))
    return sums.select("cluster_id", "n", mean.alias("centroid"))


def minibatch_kmeans(
    catalog: DataFrame,
    k: int = 8,
    seed: int = 42,
    max_iter: int = 300,
    batch_size: int = 2048,
    metric: str = "cosine",
    n_init: int = 1,
    vector_column: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Centroids from random batches, each moving the centroids it touches.

    All rows are dealt once to batches of about ``batch_size`` rows, or to
    ``PASS_BATCHES`` larger ones, and written to the shared folder; each round
    reads only its own batch, and each pass takes the batches in another order. There are at most ``max_iter`` passes; the fit ends
    when a whole pass moves no centroid by more than ``SETTLED`` of its length.
    Centroids beyond the broadcast limit are fitted by :func:`kmeans`.
    """
    rows = _vectors(catalog, metric, vector_column)
    if not _fits(rows, k, vector_column, broadcast_bytes):
        return kmeans(catalog, k, seed, max_iter, metric, n_init, vector_column, broadcast_bytes)
    rounds = min(PASS_BATCHES, math.ceil(rows.count() / batch_size))
    space = "cosine" if metric == "cosine" else "l2"
    dealt = rows.withColumn("round", F.floor(F.rand(seed) * rounds).cast("int"))
    batches = materialize(dealt.repartition("round"), ["round"])
    start = batches.where(F.col("round") < math.ceil(rounds / 4)).drop("round")
    centers = _fit(start, k, seed, 1, metric, n_init)
    labels, seen = np.arange(len(centers)), np.zeros(len(centers))
    for step in range(max_iter):
        before = centers.copy()
        for i in np.random.default_rng(seed + step).permutation(rounds):
            batch = batches.where(F.col("round") == int(i))
            sums = _cluster_sums(batch, labels, _unit(centers, metric), space, vector_column)
            for row in sums.collect():
                c = row["cluster_id"]
                seen[c] += row["n"]
                pull = row["n"] / seen[c]
                centers[c] += pull * (np.array(row["total"]) / row["n"] - centers[c])
        moves = np.linalg.norm(centers - before, axis=1)
        if (moves <= SETTLED * (np.linalg.norm(before, axis=1) + vectors.EPSILON)).all():
            break
    return _centroid_table(catalog.sparkSession, _unit(centers, metric))


def _unit(centers: np.ndarray, metric: str) -> np.ndarray:
    if metric not in INNER_PRODUCT:
        return centers
    return centers / (np.linalg.norm(centers, axis=1, keepdims=True) + vectors.EPSILON)


def cluster_means(
    members: DataFrame, cluster_column: str = "cluster_id", vector_column: str = "embedding"
) -> DataFrame:
    """``(cluster_id, n, centroid)``: the mean vector of each cluster's members."""
    rows = members.where(F.col(vector_column).isNotNull())
    return rows.groupBy(F.col(cluster_column).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.mean(_as_vector(vector_column))).alias("centroid"),
    )


def unit_centroids(centroids: DataFrame) -> DataFrame:
    return centroids.withColumn("centroid", vectors.normalize(F.col("centroid")))


def assign_catalog(
    catalog: DataFrame,
    centroids: DataFrame,
    vector_column: str = "embedding",
    **options,
) -> DataFrame:
    """``(item_id, group_id, cluster_id, sim_to_centroid)`` by best unit centroid."""
    hits = attach_nearest(catalog, unit_centroids(centroids), vector_column=vector_column, **options)
    return hits.drop(vector_column, "rank").withColumnRenamed("score", "sim_to_centroid")


def label_disagreement(
    catalog: DataFrame, centroids: DataFrame, vector_column: str = "embedding"
) -> DataFrame:
    """``(n, disagree)``: rows whose nearest centroid by distance is not the
    one with the best cosine."""
    by_distance = attach_nearest(
        catalog.select("item_id", vector_column), centroids, metric="l2", vector_column=vector_column
    ).drop("score", "rank")
    both = attach_nearest(
        by_distance.withColumnRenamed("cluster_id", "label"),
        unit_centroids(centroids),
        vector_column=vector_column,
    )
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") != F.col("cluster_id")).alias("disagree"),
    )


def cluster_sizes(assignments: DataFrame, cluster_column: str = "cluster_id") -> DataFrame:
    return assignments.groupBy(cluster_column).agg(F.count(F.lit(1)).alias("size"))


def size_balance(assignments: DataFrame, cluster_column: str = "cluster_id") -> DataFrame:
    """``(clusters, total, size_balance)`` with ``1 - sum(p^2)``; 0 for one cluster."""
    sizes = cluster_sizes(assignments, cluster_column)
    n = F.col("size").cast("double")
    sums = sizes.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total"),
        F.sum(n * n).alias("squares"),
    )
    balance = F.lit(1.0) - F.col("squares") / (F.col("total") * F.col("total").cast("double"))
    return sums.select(
        "clusters",
        "total",
        F.when(F.col("clusters") > 1, balance).otherwise(F.lit(0.0)).alias("size_balance"),
    )
