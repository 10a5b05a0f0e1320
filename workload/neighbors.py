"""Queries for nearest neighbours and retrieval quality on the vectors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalith.functions import vectors
from catalith.operators import evaluate, knn
from catalith.operators.cluster import cluster_means
from catalith.operators.encode import normalize_vectors
from catalith.session import shared_folder
from catalith.sources import readers, writers

from .tables import vectors as catalog_vectors

K = 10


def _cells(catalog):
    """The mean of each label as the center of a cell."""
    means = cluster_means(catalog, "group_id")
    return means.select(F.col("cluster_id").alias("cell_id"), "centroid")


def vector_norms(spark, folder):
    """Norms before and after doubling and scaling back to unit length."""
    catalog = catalog_vectors(spark, folder)
    doubled = catalog.withColumn("embedding", F.transform("embedding", lambda x: x * 2))
    unit = normalize_vectors(doubled)
    return unit.select(
        "item_id",
        F.round(vectors.l2_norm(F.col("embedding")), 6).alias("norm"),
        F.round(vectors.dot(F.col("embedding"), F.col("embedding")), 6).alias("square"),
    )


def knn_exact(spark, folder):
    catalog = catalog_vectors(spark, folder)
    return knn.nearest(catalog, catalog, K, exclude_self=True)


def knn_broadcast_queries(spark, folder):
    catalog = catalog_vectors(spark, folder)
    return knn.nearest(catalog, catalog, K, exclude_self=True, plan="left", block_rows=20)


def knn_blocked(spark, folder):
    catalog = catalog_vectors(spark, folder)
    return knn.nearest(catalog, catalog, K, exclude_self=True, plan="blocks", block_rows=60)


def _repeated(catalog):
    """Vectors of which some have no id and some share one."""
    item = F.when(F.col("item_id") % 7 == 0, None).otherwise(F.floor(F.col("item_id") / 3))
    return catalog.withColumn("item_id", item.cast("long"))


def _repeated_ids(spark, folder, **options):
    queries = _repeated(catalog_vectors(spark, folder))
    found = knn.nearest(queries, catalog_vectors(spark, folder), 3, exclude_self=True, **options)
    return found.select("query_id", "candidate_id", "score", "rank")


def knn_repeated_ids_right(spark, folder):
    return _repeated_ids(spark, folder, plan="right")


def knn_repeated_ids_left(spark, folder):
    return _repeated_ids(spark, folder, plan="left", block_rows=40)


def knn_repeated_ids_blocks(spark, folder):
    return _repeated_ids(spark, folder, plan="blocks", block_rows=60)


def knn_repeated_ids_cells(spark, folder):
    catalog = catalog_vectors(spark, folder)
    cells = _cells(catalog)
    found = knn.nearest_in_cells(
        _repeated(catalog), knn.assign_cells(catalog, cells), cells, 3, nprobe=10, exclude_self=True, block_rows=60
    )
    return found.select("query_id", "candidate_id", "score", "rank")


def knn_l2(spark, folder):
    catalog = catalog_vectors(spark, folder)
    return knn.nearest(catalog, catalog, K, "l2")


def _stored(spark, folder):
    """The folder of the catalogue by cells, and what is read back from it."""
    catalog = catalog_vectors(spark, folder)
    cells = _cells(catalog)
    path = f"{shared_folder(spark)}/catalith-cells-{uuid.uuid4().hex}"
    writers.write_cells(knn.assign_cells(catalog, cells), cells, path)
    return path, *readers.read_cells(spark, path)


def knn_cells_all(spark, folder):
    """All cells probed, from cells written to and read back from disk."""
    _, members, cells = _stored(spark, folder)
    catalog = catalog_vectors(spark, folder)
    return knn.nearest_in_cells(catalog, members, cells, K, nprobe=10, exclude_self=True)


def knn_cells_probed(spark, folder):
    catalog = catalog_vectors(spark, folder)
    cells = _cells(catalog)
    members = knn.assign_cells(catalog, cells)
    return knn.nearest_in_cells(catalog, members, cells, K, nprobe=3, exclude_self=True)


def nearest_pairs(spark, folder):
    return knn.nearest_pairs(catalog_vectors(spark, folder))


def nearest_pairs_repeated_ids(spark, folder):
    """Pairs of a catalogue whose ids are null or repeat: one row per vector, each with its own group."""
    found = knn.nearest_pairs(_repeated(catalog_vectors(spark, folder)))
    return found.select("item_id", "group_id", "nearest_group", "score")


def precision_repeated_ids(spark, folder):
    """Precision with every row of such a catalogue as a query of its own."""
    catalog = _repeated(catalog_vectors(spark, folder))
    found = evaluate.evaluate(catalog, catalog, 5).where("metric = 'p'")
    return found.withColumn("value", F.round("value", 6))


def knn_by_bounds(spark, folder):
    """Exact neighbours from stored cells, of which those out of reach are not read."""
    path, _, cells = _stored(spark, folder)
    members, _ = readers.read_cells(spark, path)
    catalog = catalog_vectors(spark, folder)
    found = knn.nearest_by_bounds(catalog, path, knn.cell_radii(members, cells), K, exclude_self=True)
    return found.drop("compared")


def knn_cells_dealt(spark, folder):
    """Queries beyond the broadcast limit, dealt to the cells they probe."""
    path, members, cells = _stored(spark, folder)
    catalog = catalog_vectors(spark, folder)
    return knn.nearest_in_cells(
        catalog, members, cells, K, nprobe=3, exclude_self=True, broadcast_bytes=1, block_rows=40, stored=path
    )


def _metrics(spark, folder, metric):
    catalog = catalog_vectors(spark, folder)
    found = evaluate.evaluate(catalog, catalog, K).where(F.col("metric") == metric)
    return found.withColumn("value", F.round("value", 6))


def precision_at_k(spark, folder):
    return _metrics(spark, folder, "p")


def map_at_k(spark, folder):
    return _metrics(spark, folder, "map")


QUERIES = {
    f.__name__: f
    for f in (
        vector_norms,
        knn_exact,
        knn_broadcast_queries,
        knn_blocked,
        knn_repeated_ids_right,
        knn_repeated_ids_left,
        knn_repeated_ids_blocks,
        knn_repeated_ids_cells,
        knn_l2,
        knn_cells_all,
        knn_cells_probed,
        nearest_pairs,
        nearest_pairs_repeated_ids,
        precision_repeated_ids,
        knn_by_bounds,
        knn_cells_dealt,
        precision_at_k,
        map_at_k,
    )
}

DOUBLES_SQL = """
v AS (SELECT vec_id AS id, label AS g, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
"""
COSINE_SQL = "round(list_inner_product(q.e, c.e) / sqrt(list_inner_product(q.e, q.e) * list_inner_product(c.e, c.e)), 9)"


def ranked_sql(score: str, k: int, on: str = "q.id <> c.id") -> str:
    return f"""
ranked AS (
  SELECT q.id AS query_id, c.id AS candidate_id, c.g AS candidate_group, q.g AS query_group,
         {score} AS score,
         CAST(row_number() OVER (PARTITION BY q.id ORDER BY {score} DESC, c.id) AS INTEGER) AS rank
  FROM v q JOIN v c ON {on} QUALIFY rank <= {k})
"""


_OUT = "query_id, candidate_id, candidate_group, score, rank"
_EXACT = f"WITH {DOUBLES_SQL}, {ranked_sql(COSINE_SQL, K)} SELECT {_OUT} FROM ranked"

MEANS_SQL = """
dims AS (SELECT id, g, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM v),
avgs AS (SELECT g, p, avg(x) AS x FROM dims GROUP BY g, p),
means AS (SELECT g AS cluster_id, list(x ORDER BY p) AS m FROM avgs GROUP BY g)
"""

_CELLS = f"""
WITH {DOUBLES_SQL}, {MEANS_SQL},
probe AS (
  SELECT q.id, c.cluster_id AS cell,
         row_number() OVER (
           PARTITION BY q.id
           ORDER BY round(list_inner_product(q.e, c.m), 9) DESC, c.cluster_id) AS r
  FROM v q CROSS JOIN means c),
{ranked_sql(COSINE_SQL, K, '''q.id <> c.id
    JOIN probe pc ON pc.id = c.id AND pc.r = 1
    JOIN probe pq ON pq.id = q.id AND pq.r <= 3 AND pq.cell = pc.cell''')}
SELECT {_OUT} FROM ranked
"""

_METRICS = f"""
WITH {DOUBLES_SQL}, {ranked_sql(COSINE_SQL, K)},
judged AS (SELECT *, CAST(candidate_group = query_group AS INTEGER) AS rel FROM ranked),
running AS (SELECT *, sum(rel) OVER (PARTITION BY query_id ORDER BY rank) AS hits FROM judged),
cuts AS (SELECT unnest([1, 3, 5, 10]) AS k),
per_query AS (
  SELECT query_id, k, sum(rel) AS relevant, count(*) AS returned,
         coalesce(avg(hits / rank) FILTER (rel = 1), 0) AS ap
  FROM running JOIN cuts ON rank <= k GROUP BY ALL)
"""

# Rows in the order of their ids; an id that is null excludes nothing.
_REPEATED_ROWS = f"""
WITH {DOUBLES_SQL},
r AS (SELECT id AS n, CASE WHEN id % 7 <> 0 THEN id // 3 END AS id, g, e FROM v),
ranked AS (
  SELECT q.n, q.id, q.g, c.g AS other, CAST(q.g = c.g AS INTEGER) AS rel, {COSINE_SQL} AS score,
         row_number() OVER (PARTITION BY q.n ORDER BY {COSINE_SQL} DESC, c.id NULLS LAST, c.g) AS rank
  FROM r q JOIN r c ON q.id IS NULL OR c.id IS NULL OR q.id <> c.id QUALIFY rank <= 5)
"""

_REPEATED = f"""
WITH {DOUBLES_SQL},
q AS (SELECT id AS n, CASE WHEN id % 7 <> 0 THEN id // 3 END AS id, e FROM v),
ranked AS (
  SELECT q.id AS query_id, c.id AS candidate_id, {COSINE_SQL} AS score,
         CAST(row_number() OVER (PARTITION BY q.n ORDER BY {COSINE_SQL} DESC, c.id) AS INTEGER) AS rank
  FROM q JOIN v c ON q.id IS NULL OR q.id <> c.id QUALIFY rank <= 3)
SELECT query_id, candidate_id, score, rank FROM ranked
"""

ORACLES = {
    "knn_repeated_ids_right": _REPEATED,
    "knn_repeated_ids_left": _REPEATED,
    "knn_repeated_ids_blocks": _REPEATED,
    "knn_repeated_ids_cells": _REPEATED,
    "vector_norms": """
SELECT vec_id AS item_id, round(sqrt(list_inner_product(u, u)), 6) AS norm,
       round(list_inner_product(u, u), 6) AS square
FROM (
  SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))""",
    "knn_exact": _EXACT,
    "knn_broadcast_queries": _EXACT,
    "knn_blocked": _EXACT,
    "knn_l2": f"""
WITH {DOUBLES_SQL}, {ranked_sql("round(-list_distance(q.e, c.e), 9)", K, "true")}
SELECT {_OUT} FROM ranked""",
    "knn_cells_all": _EXACT,
    "knn_by_bounds": _EXACT,
    "knn_cells_dealt": _CELLS,
    "nearest_pairs_repeated_ids": f"""{_REPEATED_ROWS}
SELECT id AS item_id, g AS group_id, other AS nearest_group, score FROM ranked WHERE rank = 1""",
    "precision_repeated_ids": f"""{_REPEATED_ROWS}
SELECT 'all' AS slice, 'p' AS metric, k, round(sum(rel) / count(*), 6) AS value, count(DISTINCT n) AS n
FROM ranked JOIN (SELECT unnest([1, 3, 5]) AS k) ON rank <= k GROUP BY k""",
    "knn_cells_probed": _CELLS,
    "nearest_pairs": f"""
WITH {DOUBLES_SQL}, {ranked_sql(COSINE_SQL, 1)}
SELECT query_id AS item_id, query_group AS group_id, candidate_id AS nearest_id,
       candidate_group AS nearest_group, score
FROM ranked""",
    "precision_at_k": f"""{_METRICS}
SELECT 'all' AS slice, 'p' AS metric, k, round(sum(relevant) / sum(returned), 6) AS value,
       count(*) AS n
FROM per_query GROUP BY k""",
    "map_at_k": f"""{_METRICS}
SELECT 'all' AS slice, 'map' AS metric, k, round(avg(ap), 6) AS value, count(*) AS n
FROM per_query WHERE k > 1 GROUP BY k""",
}
