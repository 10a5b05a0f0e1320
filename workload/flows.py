"""Queries for tables written and read back, new items, and evaluation through cells."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Observation
from pyspark.sql import functions as F

from catalith.functions import vectors
from catalith.operators import columns, encode, evaluate, knn, report
from catalith.operators.cluster import cluster_means, unit_centroids
from catalith.plans import catalog as plans
from catalith.plans import clusters
from catalith.plans.prepare import prepare
from catalith.session import materialize, shared_folder
from catalith.sources import readers, writers

from .clusters import _DISTRIBUTION_SQL, _ASSIGNED_SQL, _assigned, _separated, silhouette_sql
from .items import document_views
from .neighbors import DOUBLES_SQL, K, _METRICS, _cells
from .tables import DOCUMENT_VIEWS_SQL, GENERIC_PARTS, order_chapters, order_items
from .tables import vectors as catalog_vectors
from .texts import embedding_text_sql

# The letters that the stand-in for a model counts.
LETTERS = "aeinorst"


class LetterEncoder:
    """Counts of some letters, as a model that SQL can repeat."""

    def encode(self, texts):
        return np.array([[t.lower().count(c) for c in LETTERS] for t in texts], dtype=float)


def _path(spark, kind):
    return f"{shared_folder(spark)}/catalith-{kind}-{uuid.uuid4().hex}"


def chapters_csv(spark, folder):
    """Chapters written as CSV with raw headers and read back through the contract."""
    path = _path(spark, "chapters") + ".csv"
    raw = order_chapters(spark, folder).select(
        F.lit("s").alias("SCOPE"),
        F.lit("g").alias("GROUP"),
        F.col("item_id").alias("ITEM"),
        F.col("chapter_number").alias("NO"),
        F.col("chapter_title").alias("NAME"),
        F.when(F.col("attestation") != "N", F.col("attestation")).alias("MARK"),
    )
    raw.write.option("header", True).csv(path)
    aliases = {"SCOPE": "scope", "GROUP": "group_id", "ITEM": "item_id", "NO": "chapter_number"}
    aliases |= {"NAME": "chapter_title", "MARK": "attestation"}
    found = readers.load_chapters(spark, path, aliases=aliases, multi_line=False)
    return found.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.col("chapter_number").cast("long").alias("chapter_number"),
        "chapter_title",
        "attestation",
    )


def vectors_round_trip(spark, folder):
    """Vectors written and read back, by their norm and first number."""
    path = _path(spark, "vectors")
    writers.write_vectors(catalog_vectors(spark, folder), path)
    found = readers.read_vectors(spark, path)
    return found.select(
        "item_id",
        F.round(vectors.l2_norm(F.col("embedding")), 6).alias("norm"),
        F.round(F.element_at("embedding", 1).cast("double"), 6).alias("head"),
    )


def json_round_trip(spark, folder):
    """A report table with a list column as JSON lines and back."""
    path = _path(spark, "json")
    shares = report.group_distribution(_assigned(spark, folder))
    lists = shares.groupBy("cluster_id").agg(F.sort_array(F.collect_list("group_id")).alias("groups"))
    writers.write_json(lists, path)
    found = spark.read.schema("cluster_id int, groups array<int>").json(path)
    return found.select("cluster_id", F.size("groups").alias("n"), F.explode("groups").alias("group_id"))


def prepared_counts(spark, folder):
    """Rows of both tables before and after the scope, as the preparation reports them."""
    scopes = order_items(spark, folder).select("item_id", "scope")
    counts = {name: Observation(name) for name in ("master_in", "master_out", "chapters_in", "chapters_out")}
    prepared = prepare(
        order_items(spark, folder), order_chapters(spark, folder).join(scopes, "item_id"), "F", ["workload"],
        GENERIC_PARTS, counts=counts, out=_path(spark, "prepared"),
    )
    views = prepared.count()
    rows = [(name, seen.get["n"]) for name, seen in counts.items()] + [("views", views)]
    return spark.createDataFrame(rows, "stage string, n long")


def merged_columns(spark, folder):
    """Columns that a join left twice, merged, after a check that they are there."""
    orders = order_items(spark, folder).select("item_id", F.col("title").alias("title_x"))
    chapters = order_chapters(spark, folder).groupBy("item_id").agg(F.max("chapter_title").alias("title_y"))
    orders = orders.withColumn("title_x", F.when(F.col("item_id") % 2 == 0, F.col("title_x")))
    both = columns.coalesce_suffixes(orders.join(chapters, "item_id", "left"), "title")
    return columns.require_columns(both, ["item_id", "title"])


def distance_scores(spark, folder):
    """Distances to one vector as scores of both kinds."""
    catalog = catalog_vectors(spark, folder)
    first = F.array(*map(F.lit, catalog.where("item_id = 0").head()["embedding"]))
    gap = vectors.euclidean(F.col("embedding"), first)
    angle = F.lit(1.0) - vectors.dot(F.col("embedding"), first)
    return catalog.select(
        "item_id",
        F.round(vectors.distance_to_score(gap, "l2"), 6).alias("l2"),
        F.round(vectors.distance_to_score(angle, "cosine"), 6).alias("cosine"),
    )


def plugged_encoder(spark, folder):
    """Vectors of a given encoder, number by number."""
    catalog = plans.build_catalog(document_views(spark, folder), make_encoder=LetterEncoder)
    cells = catalog.select("item_id", "group_id", F.posexplode("embedding").alias("pos", "value"))
    return cells.withColumn("value", F.round(F.col("value").cast("double"), 6))


def _old_and_new(spark, folder):
    views = document_views(spark, folder)
    return views.where("item_id % 2 = 0"), views.where("item_id % 2 = 1")


def new_item_neighbors(spark, folder):
    """New items among the catalogue of the others."""
    old, new = _old_and_new(spark, folder)
    catalog = materialize(plans.build_catalog(old, make_encoder=LetterEncoder))
    return plans.find_neighbors(new, catalog, 3, make_encoder=LetterEncoder)


def new_item_neighbors_cells(spark, folder):
    """New items among the catalogue of the others, stored by cells, of which all are probed."""
    old, new = _old_and_new(spark, folder)
    catalog = materialize(plans.build_catalog(old, make_encoder=LetterEncoder))
    members, cells = plans.build_cells(catalog, 6, _path(spark, "cells"))
    return plans.find_neighbors(new, members, 3, make_encoder=LetterEncoder, cells=cells, nprobe=6)


def new_item_clusters(spark, folder):
    """New items in clusters of the others, by source; unlike ones in none."""
    old, new = _old_and_new(spark, folder)
    catalog = plans.build_catalog(old, make_encoder=LetterEncoder)
    label = F.regexp_replace("group_id", "src", "").cast("int")
    means = cluster_means(catalog.withColumn("cluster_id", label)).select("cluster_id", "centroid")
    found = plans.assign_views(new, unit_centroids(means), 0.97, make_encoder=LetterEncoder)
    return found.withColumn("score", F.round("score", 6))


def precision_in_cells(spark, folder):
    """Precision of a search through all cells, which is the exact one."""
    catalog = catalog_vectors(spark, folder)
    cells = _cells(catalog)
    found = evaluate.evaluate(catalog, knn.assign_cells(catalog, cells), K, cells=cells, nprobe=10)
    return found.where("metric = 'p'").withColumn("value", F.round("value", 6))


def tuning_search(spark, folder):
    """The search on vectors whose clusters are certain: both trials measure the same."""
    grid = clusters.parameter_grid([10], w_chaps=[1.0, 1.5], w_meta=[0.5])
    trials = clusters.tune(
        catalog_vectors(spark, folder), grid, max_iter=50, n_init=2,
        make_catalog=lambda views, weights: _separated(spark, folder),
    )
    measures = ("purity", "silhouette", "size_balance", "score")
    return trials.withColumns({c: F.round(c, 6) for c in measures})


QUERIES = {
    f.__name__: f
    for f in (
        chapters_csv,
        vectors_round_trip,
        json_round_trip,
        prepared_counts,
        merged_columns,
        distance_scores,
        plugged_encoder,
        new_item_neighbors,
        new_item_neighbors_cells,
        new_item_clusters,
        precision_in_cells,
        tuning_search,
    )
}

_LETTERS_SQL = f"""
texts AS (SELECT item_id, group_id, lower({embedding_text_sql(2.0, 1.0, 0.5)}) AS t FROM views),
counts AS (
  SELECT item_id, group_id,
         list_transform(string_split('{",".join(LETTERS)}', ','), lambda c: CAST(len(t) - len(replace(t, c, '')) AS DOUBLE)) AS c
  FROM texts),
coded AS (
  SELECT item_id, group_id,
         list_transform(c, lambda x: CAST(CAST(x / (sqrt(list_inner_product(c, c)) + 1e-12) AS FLOAT) AS DOUBLE)) AS e
  FROM counts)
"""

_COSINE = "round(coalesce(list_inner_product(q.e, c.e) / nullif(sqrt(list_inner_product(q.e, q.e) * list_inner_product(c.e, c.e)), 0), 0), 9)"
_NEW_NEIGHBORS = f"""
WITH {DOCUMENT_VIEWS_SQL}, {_LETTERS_SQL},
ranked AS (
  SELECT q.item_id AS query_id, c.item_id AS candidate_id, c.group_id AS candidate_group,
         {_COSINE} AS score,
         CAST(row_number() OVER (PARTITION BY q.item_id ORDER BY {_COSINE} DESC, c.item_id) AS INTEGER) AS rank
  FROM coded q JOIN coded c ON q.item_id % 2 = 1 AND c.item_id % 2 = 0 QUALIFY rank <= 3)
SELECT query_id, candidate_id, candidate_group, score, rank FROM ranked"""

ORACLES = {
    "chapters_csv": """
SELECT l_orderkey AS item_id, CAST(l_linenumber AS BIGINT) AS chapter_number, p_name AS chapter_title,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS attestation
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "vectors_round_trip": f"""
WITH {DOUBLES_SQL}
SELECT id AS item_id, round(sqrt(list_inner_product(e, e)), 6) AS norm, round(e[1], 6) AS head FROM v""",
    "json_round_trip": f"""
WITH {_ASSIGNED_SQL}, {_DISTRIBUTION_SQL}
SELECT cluster_id, CAST(count(*) OVER (PARTITION BY cluster_id) AS INTEGER) AS n, g AS group_id FROM dist""",
    "prepared_counts": """
SELECT 'master_in' AS stage, count(*) AS n FROM orders
UNION ALL SELECT 'master_out', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'views', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'chapters_in', count(*) FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'chapters_out', count(*) FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
    "merged_columns": """
SELECT o_orderkey AS item_id, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, p) AS title
FROM orders LEFT JOIN (
  SELECT l_orderkey, max(p_name) AS p FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
ON l_orderkey = o_orderkey""",
    "distance_scores": f"""
WITH {DOUBLES_SQL}, f AS (SELECT e FROM v WHERE id = 0)
SELECT v.id AS item_id, round(-list_distance(v.e, f.e), 6) AS l2, round(list_inner_product(v.e, f.e), 6) AS cosine
FROM v CROSS JOIN f""",
    "plugged_encoder": f"""
WITH {DOCUMENT_VIEWS_SQL}, {_LETTERS_SQL}
SELECT item_id, group_id, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS pos, round(unnest(e), 6) AS value FROM coded""",
    "new_item_neighbors": _NEW_NEIGHBORS,
    "new_item_neighbors_cells": _NEW_NEIGHBORS,
    "new_item_clusters": f"""
WITH {DOCUMENT_VIEWS_SQL}, {_LETTERS_SQL},
sides AS (
  SELECT CAST(replace(group_id, 'src', '') AS INTEGER) AS cluster_id, unnest(e) AS x, generate_subscripts(e, 1) AS p
  FROM coded WHERE item_id % 2 = 0),
avgs AS (SELECT cluster_id, p, avg(x) AS x FROM sides GROUP BY ALL),
means AS (SELECT cluster_id, list(x ORDER BY p) AS m FROM avgs GROUP BY cluster_id),
unit AS (SELECT cluster_id, list_transform(m, lambda x: x / (sqrt(list_inner_product(m, m)) + 1e-12)) AS m FROM means),
best AS (
  SELECT item_id, cluster_id, round(list_inner_product(e, m), 9) AS s FROM coded CROSS JOIN unit WHERE item_id % 2 = 1
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(list_inner_product(e, m), 9) DESC, cluster_id) = 1)
SELECT item_id, CASE WHEN s >= 0.97 THEN cluster_id ELSE -1 END AS assigned_cluster, round(s, 6) AS score, 1 AS rank
FROM best""",
    "precision_in_cells": f"""{_METRICS}
SELECT 'all' AS slice, 'p' AS metric, k, round(sum(relevant) / sum(returned), 6) AS value, count(*) AS n
FROM per_query GROUP BY k""",
    "tuning_search": f"""
WITH {DOUBLES_SQL},
apart AS (
  SELECT id, g AS c,
         list_transform(e, lambda x, i: CAST(CAST(x + CASE WHEN i - 1 = g THEN 20.0 ELSE 0.0 END AS FLOAT) AS DOUBLE)) AS e
  FROM v),
{silhouette_sql("apart")},
measured AS (
  SELECT 1.0::DOUBLE AS purity, (SELECT avg(s) FROM items) AS silhouette,
         (SELECT 1 - sum((n / total) * (n / total)) FROM (
            SELECT count(*) AS n, sum(count(*)) OVER () AS total FROM v GROUP BY g)) AS size_balance)
SELECT CAST(10 AS INTEGER) AS k, 2.0::DOUBLE AS w_title, w::DOUBLE AS w_chaps, 0.5::DOUBLE AS w_meta,
       round(purity, 6) AS purity, round(silhouette, 6) AS silhouette, round(size_balance, 6) AS size_balance,
       round(0.5 * purity + 0.3 * (silhouette + 1) / 2 + 0.2 * size_balance, 6) AS score
FROM measured CROSS JOIN (SELECT unnest([1.0, 1.5]) AS w)""",
}
