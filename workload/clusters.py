"""Queries for clusters: fitting, assignment, quality, report and tuning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalith.functions import text
from catalith.operators import assign, cluster, quality, report
from catalith.operators.knn import attach_nearest
from catalith.plans import clusters as plans

from .neighbors import DOUBLES_SQL, MEANS_SQL
from .tables import DOCUMENT_VIEWS_SQL, read
from .tables import vectors as catalog_vectors
from .texts import TOKEN_SQL, document_views


def _label_means(spark, folder):
    return cluster.cluster_means(catalog_vectors(spark, folder), "group_id")


def _unit_means(spark, folder):
    return cluster.unit_centroids(_label_means(spark, folder).select("cluster_id", "centroid"))


def _assigned(spark, folder):
    means = _label_means(spark, folder).select("cluster_id", "centroid")
    return cluster.assign_catalog(catalog_vectors(spark, folder), means)


def _cells(centroids, *keys):
    cells = centroids.select("cluster_id", *keys, F.posexplode("centroid").alias("pos", "value"))
    return cells.withColumn("value", F.round("value", 6))


def cluster_centroids(spark, folder):
    means = _label_means(spark, folder)
    return _cells(cluster.unit_centroids(means), "n")


def lloyd_step(spark, folder):
    start = _label_means(spark, folder).select("cluster_id", "centroid")
    return _cells(cluster.lloyd_step(catalog_vectors(spark, folder), start), "n")


def lloyd_step_blocked(spark, folder):
    """The same step with centroids that count as too large to broadcast."""
    start = _label_means(spark, folder).select("cluster_id", "centroid")
    return _cells(cluster.lloyd_step(catalog_vectors(spark, folder), start, broadcast_bytes=1), "n")


def assign_catalog(spark, folder):
    return _assigned(spark, folder)


def assign_new_outlier(spark, folder):
    return assign.assign_new(catalog_vectors(spark, folder), _unit_means(spark, folder), 0.35)


def _repeated_assignment(spark, folder, **limits):
    """New items of which some have no id and some share one."""
    item = F.when(F.col("item_id") % 7 == 0, None).otherwise(F.floor(F.col("item_id") / 3)).cast("long")
    new = catalog_vectors(spark, folder).withColumn("item_id", item)
    return assign.assign_new(new, _unit_means(spark, folder), 0.35, **limits)


def assign_repeated_ids(spark, folder):
    return _repeated_assignment(spark, folder)


def assign_repeated_ids_blocked(spark, folder):
    return _repeated_assignment(spark, folder, broadcast_bytes=1)


def label_disagreement(spark, folder):
    means = _label_means(spark, folder).select("cluster_id", "centroid")
    return cluster.label_disagreement(catalog_vectors(spark, folder), means)


def _by_label(spark, folder):
    return catalog_vectors(spark, folder).withColumnRenamed("group_id", "cluster_id")


def silhouette_exact(spark, folder):
    found = quality.silhouette(_by_label(spark, folder))
    return found.withColumn("silhouette", F.round("silhouette", 6))


def silhouette_blocked(spark, folder):
    """The silhouette of every item, compared block by block."""
    found = quality.silhouette_by_item(_by_label(spark, folder), plan="blocks", block_rows=60)
    return found.withColumn("silhouette", F.round("silhouette", 6))


def _squared(spark, folder, **limits):
    found = quality.silhouette_squared(_by_label(spark, folder), **limits)
    return found.withColumn("silhouette", F.round("silhouette", 6))


def silhouette_squared(spark, folder):
    return _squared(spark, folder)


def silhouette_squared_blocked(spark, folder):
    """The same with sums of clusters that count as too large to broadcast."""
    return _squared(spark, folder, plan="blocks", block_rows=4)


def silhouette_repeated_ids(spark, folder):
    """Ids that repeat change nothing: every row is an item."""
    rows = _by_label(spark, folder).withColumn("item_id", F.floor(F.col("item_id") / 50))
    found = quality.silhouette(rows, plan="blocks", block_rows=60)
    return found.withColumn("silhouette", F.round("silhouette", 6))


def davies_bouldin(spark, folder):
    found = quality.davies_bouldin(_by_label(spark, folder))
    return found.withColumn("davies_bouldin", F.round("davies_bouldin", 6))


def cluster_quality(spark, folder):
    found = quality.cluster_quality(_by_label(spark, folder))
    for name in ("silhouette", "davies_bouldin"):
        found = found.withColumn(name, F.round(name, 6))
    return found


def _separated(spark, folder):
    """The vectors, each pulled towards an axis of its label."""
    shift = F.transform(
        "embedding",
        lambda x, i: (x + F.when(i == F.col("group_id"), 20.0).otherwise(0.0)).cast("float"),
    )
    return catalog_vectors(spark, folder).withColumn("embedding", shift)


def _recovered(assignments):
    """Clusters by the one label they hold."""
    return report.majority_groups(report.group_distribution(assignments)).join(
        cluster.cluster_sizes(assignments), "cluster_id"
    ).select("major_group", "size", "purity")


def kmeans_fit(spark, folder):
    """k-means must find the ten labels in vectors pulled apart by label."""
    assignments, _ = plans.cluster_catalog(_separated(spark, folder), 10, n_init=2)
    return _recovered(assignments)


def kmeans_euclidean(spark, folder):
    assignments, _ = plans.cluster_catalog(_separated(spark, folder), 10, metric="euclidean", n_init=2)
    return _recovered(assignments)


def kmeans_blocked(spark, folder):
    """The fit with centroids that count as too large to broadcast."""
    vectors_ = _separated(spark, folder)
    centers = cluster.kmeans(vectors_, 10, max_iter=5, metric="euclidean", broadcast_bytes=1)
    hits = attach_nearest(vectors_, centers, metric="l2").withColumnRenamed("score", "sim_to_centroid")
    return _recovered(hits.drop("rank"))


def minibatch_fit(spark, folder):
    assignments, _ = plans.cluster_catalog(
        _separated(spark, folder), 10, "minibatch", batch_size=512, n_init=2
    )
    return _recovered(assignments)


def group_distribution(spark, folder):
    found = report.group_distribution(_assigned(spark, folder))
    return found.withColumn("pct", F.round("pct", 6))


def purity(spark, folder):
    found = report.majority_groups(report.group_distribution(_assigned(spark, folder)))
    return found.withColumn("purity", F.round("purity", 6))


def exemplars(spark, folder):
    found = report.exemplars(_assigned(spark, folder))
    return found.withColumn("exemplars", text.json_list(F.col("exemplars")))


def _documents_by_language(spark, folder):
    """Documents clustered by language; similarity is a share of the length."""
    langs = read(spark, folder, "documents").select(
        F.col("doc_id").alias("item_id"),
        F.col("source").alias("group_id"),
        F.when(F.col("lang") == "en", 0)
        .when(F.col("lang") == "fr", 1)
        .otherwise(2)
        .alias("cluster_id"),
        (F.col("n_chars") % 1000 / 1000).alias("sim_to_centroid"),
    )
    return langs


def cluster_summary(spark, folder):
    """The whole report of documents clustered by language."""
    tables = report.cluster_report(
        _documents_by_language(spark, folder), document_views(spark, folder)
    )
    # Means of three-digit numbers often end in a half at the sixth digit.
    found = tables["summary"].withColumns(
        {"avg_sim": F.round("avg_sim", 9), "purity": F.round("purity", 6)}
    )
    for name in ("top_terms", "exemplars"):
        found = found.withColumn(name, text.json_list(F.col(name)))
    return found


def global_report(spark, folder):
    found = report.global_report(report.cluster_summary(_assigned(spark, folder)))
    for name in ("avg_cluster_size", "mean_purity", "mean_avg_sim"):
        found = found.withColumn(name, F.round(name, 6))
    return found


def size_balance(spark, folder):
    found = cluster.size_balance(_assigned(spark, folder))
    return found.withColumn("size_balance", F.round("size_balance", 6))


def cluster_sizes(spark, folder):
    return cluster.cluster_sizes(_assigned(spark, folder))


def _trial(spark, folder, k):
    """Items dealt to ``k`` clusters by their id, measured as one trial."""
    dealt = catalog_vectors(spark, folder).withColumns(
        {"cluster_id": (F.col("item_id") % k).cast("int"), "sim_to_centroid": F.lit(1.0)}
    )
    parts = [
        report.global_report(report.cluster_summary(dealt)).select(
            F.col("mean_purity").alias("purity")
        ),
        quality.silhouette(dealt).select("silhouette"),
        cluster.size_balance(dealt).select("size_balance"),
    ]
    names = ["purity", "silhouette", "size_balance"]
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), parts
    ).agg(*[F.max(n).alias(n) for n in names])
    return rows.select(F.lit(k).alias("k"), *names)


def tuning_trials(spark, folder):
    """Scores of three trials, and which of them is best."""
    rows = reduce(lambda a, b: a.unionAll(b), [_trial(spark, folder, k) for k in (4, 6, 8)])
    score = plans.tuning_score(F.col("purity"), F.col("silhouette"), F.col("size_balance"))
    trials = rows.withColumn("score", score).withColumns(
        {w: F.lit(1.0) for w in ("w_title", "w_chaps", "w_meta")}
    )
    best = plans.best_trial(trials).select("k", F.lit(True).alias("best"))
    out = trials.join(F.broadcast(best), "k", "left")
    return out.select(
        "k",
        *[F.round(c, 6).alias(c) for c in ("purity", "silhouette", "size_balance", "score")],
        F.coalesce("best", F.lit(False)).alias("best"),
    )


def tuning_grid(spark, folder):
    """The real search on the documents; fits have no SQL form."""
    grid = plans.parameter_grid([2, 4], w_chaps=[1.0, 1.5], w_meta=[0.5, 0.0])
    return plans.tune(document_views(spark, folder), grid, dim=64, max_iter=20)


QUERIES = {
    f.__name__: f
    for f in (
        cluster_centroids,
        lloyd_step,
        lloyd_step_blocked,
        assign_catalog,
        assign_new_outlier,
        assign_repeated_ids,
        assign_repeated_ids_blocked,
        label_disagreement,
        silhouette_exact,
        silhouette_blocked,
        silhouette_repeated_ids,
        silhouette_squared,
        silhouette_squared_blocked,
        davies_bouldin,
        cluster_quality,
        kmeans_fit,
        kmeans_blocked,
        kmeans_euclidean,
        minibatch_fit,
        group_distribution,
        purity,
        exemplars,
        cluster_summary,
        global_report,
        size_balance,
        cluster_sizes,
        tuning_trials,
        tuning_grid,
    )
}

_UNIT_SQL = f"""
{DOUBLES_SQL}, {MEANS_SQL},
unit AS (
  SELECT cluster_id,
         list_transform(m, lambda x: x / (sqrt(list_inner_product(m, m)) + 1e-12)) AS m
  FROM means)
"""


def _best_sql(name: str, centroids: str, score: str) -> str:
    return f"""
{name} AS (
  SELECT id, g, cluster_id, s FROM (
    SELECT v.id, v.g, c.cluster_id, {score} AS s,
           row_number() OVER (PARTITION BY v.id ORDER BY {score} DESC, c.cluster_id) AS r
    FROM v CROSS JOIN {centroids} c) WHERE r = 1)
"""


_COSINE = "round(list_inner_product(v.e, c.m), 9)"
_DISTANCE = "round(-list_distance(v.e, c.m), 9)"
_ASSIGNED_SQL = f"{_UNIT_SQL}, {_best_sql('a', 'unit', _COSINE)}"

_DISTRIBUTION_SQL = """
dist AS (
  SELECT cluster_id, g, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY cluster_id) AS pct
  FROM a GROUP BY cluster_id, g),
major AS (
  SELECT cluster_id, g, pct FROM dist
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, g NULLS LAST) = 1)
"""


def silhouette_sql(members: str) -> str:
    """CTE ``items`` with one score per row of ``members (id, c, e)``."""
    return f"""
pairs AS (
  SELECT x.id, x.c, y.c AS other, sum(list_distance(x.e, y.e)) AS d, count(*) AS n
  FROM {members} x CROSS JOIN {members} y GROUP BY ALL),
ab AS (
  SELECT id, c, max(n) FILTER (other = c) AS own,
         max(d / nullif(n - 1, 0)) FILTER (other = c) AS a, min(d / n) FILTER (other <> c) AS b
  FROM pairs GROUP BY id, c),
items AS (
  SELECT id, c, CASE WHEN own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b)
                     ELSE 0 END AS s
  FROM ab)
"""


_LABELLED = f"{DOUBLES_SQL}, labelled AS (SELECT id, g AS c, e FROM v)"
_DAVIES_SQL = f"""
{MEANS_SQL},
spread AS (
  SELECT cluster_id, m, avg(list_distance(v.e, m)) AS s
  FROM v JOIN means ON v.g = cluster_id GROUP BY cluster_id, m),
worst AS (
  SELECT x.cluster_id, max((x.s + y.s) / list_distance(x.m, y.m)) AS r
  FROM spread x JOIN spread y ON x.cluster_id <> y.cluster_id GROUP BY x.cluster_id)
"""

_RECOVERED = """
SELECT label AS major_group, count(*) AS size, CAST(1 AS DOUBLE) AS purity
FROM embeddings GROUP BY label"""


def _trial_sql(k: int) -> str:
    return f"""
SELECT {k} AS k,
  (SELECT avg(p) FROM (
     SELECT c, max(n) / sum(n) AS p FROM (
       SELECT id % {k} AS c, g, count(*) AS n FROM v GROUP BY ALL) GROUP BY c)) AS purity,
  (WITH dealt AS (SELECT id, id % {k} AS c, e FROM v), {silhouette_sql("dealt")}
   SELECT avg(s) FROM items) AS silhouette,
  (SELECT 1 - sum((n / total) * (n / total)) FROM (
     SELECT count(*) AS n, sum(count(*)) OVER () AS total FROM v GROUP BY id % {k})) AS size_balance
"""


ORACLES = {
    "cluster_centroids": f"""
WITH {_UNIT_SQL}, sizes AS (SELECT g, count(*) AS n FROM v GROUP BY g)
SELECT cluster_id, n, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos,
       round(unnest(m), 6) AS value
FROM unit JOIN sizes ON g = cluster_id""",
    "lloyd_step": f"""
WITH {DOUBLES_SQL}, {MEANS_SQL}, {_best_sql("a", "means", _DISTANCE)},
moved AS (
  SELECT a.cluster_id, unnest(v.e) AS x, generate_subscripts(v.e, 1) AS p FROM a JOIN v USING (id))
SELECT cluster_id, count(*) AS n, CAST(p - 1 AS INTEGER) AS pos, round(avg(x), 6) AS value
FROM moved GROUP BY cluster_id, p""",
    "lloyd_step_blocked": "lloyd_step",
    "kmeans_blocked": "kmeans_fit",
    "assign_repeated_ids_blocked": "assign_repeated_ids",
    "assign_repeated_ids": f"""
WITH {_ASSIGNED_SQL}
SELECT CASE WHEN id % 7 <> 0 THEN id // 3 END AS item_id,
       CASE WHEN s >= 0.35 THEN cluster_id ELSE -1 END AS assigned_cluster, s AS score, 1 AS rank
FROM a""",
    "silhouette_repeated_ids": "silhouette_exact",
    "silhouette_squared_blocked": "silhouette_squared",
    "silhouette_squared": f"""
WITH {_LABELLED},
sizes AS (SELECT c, count(*) AS n FROM labelled GROUP BY c),
sums AS (
  SELECT p.id, p.c, o.c AS other, sum(list_distance(p.e, o.e) * list_distance(p.e, o.e)) AS d
  FROM labelled p JOIN labelled o ON p.id <> o.id GROUP BY ALL),
parts AS (
  SELECT id, max(CASE WHEN s.c = other THEN d / (n - 1) END) AS a, min(CASE WHEN s.c <> other THEN d / n END) AS b
  FROM sums s JOIN sizes ON sizes.c = other GROUP BY id)
SELECT (SELECT count(*) FROM labelled) AS n, (SELECT count(*) FROM sizes) AS clusters,
       round(avg((b - a) / greatest(a, b)), 6) AS silhouette
FROM parts""",
    "assign_catalog": f"""
WITH {_ASSIGNED_SQL}
SELECT id AS item_id, g AS group_id, cluster_id, s AS sim_to_centroid FROM a""",
    "assign_new_outlier": f"""
WITH {_ASSIGNED_SQL}
SELECT id AS item_id, CASE WHEN s >= 0.35 THEN cluster_id ELSE -1 END AS assigned_cluster,
       s AS score, 1 AS rank
FROM a""",
    "label_disagreement": f"""
WITH {_ASSIGNED_SQL}, {_best_sql("b", "means", _DISTANCE)}
SELECT count(*) AS n, count(*) FILTER (a.cluster_id <> b.cluster_id) AS disagree
FROM a JOIN b USING (id)""",
    "silhouette_exact": f"""
WITH {_LABELLED}, {silhouette_sql("labelled")}
SELECT count(*) AS n, count(DISTINCT c) AS clusters, round(avg(s), 6) AS silhouette FROM items""",
    "silhouette_blocked": f"""
WITH {_LABELLED}, {silhouette_sql("labelled")}
SELECT id AS item, c AS cluster_id, round(s, 6) AS silhouette FROM items""",
    "davies_bouldin": f"""
WITH {DOUBLES_SQL}, {_DAVIES_SQL}
SELECT count(*) AS clusters, round(avg(r), 6) AS davies_bouldin FROM worst""",
    "cluster_quality": f"""
WITH {_LABELLED}, {silhouette_sql("labelled")}, {_DAVIES_SQL}
SELECT count(*) AS n, (SELECT CAST(max(len(e)) AS INTEGER) FROM v) AS d,
       count(DISTINCT c) AS clusters, round(avg(s), 6) AS silhouette,
       (SELECT round(avg(r), 6) FROM worst) AS davies_bouldin
FROM items""",
    "kmeans_fit": _RECOVERED,
    "kmeans_euclidean": _RECOVERED,
    "minibatch_fit": _RECOVERED,
    "group_distribution": f"""
WITH {_ASSIGNED_SQL}, {_DISTRIBUTION_SQL}
SELECT cluster_id, g AS group_id, n AS count, round(pct, 6) AS pct FROM dist""",
    "purity": f"""
WITH {_ASSIGNED_SQL}, {_DISTRIBUTION_SQL}
SELECT cluster_id, g AS major_group, round(pct, 6) AS purity FROM major""",
    "exemplars": f"""
WITH {_ASSIGNED_SQL},
top AS (
  SELECT cluster_id, id, row_number() OVER (PARTITION BY cluster_id ORDER BY s DESC, id) AS r FROM a
  QUALIFY r <= 3)
SELECT cluster_id, '["' || string_agg(CAST(id AS VARCHAR), '","' ORDER BY r) || '"]' AS exemplars
FROM top GROUP BY cluster_id""",
    "cluster_summary": f"""
WITH {DOCUMENT_VIEWS_SQL},
a AS (
  SELECT doc_id AS id, source AS g,
         CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS cluster_id,
         n_chars % 1000 / 1000 AS s
  FROM documents),
{_DISTRIBUTION_SQL},
k AS (
  SELECT id, cluster_id, regexp_extract_all(strip_accents(lower(
           title_text || ' ' || chr(10) || ' ' || chap_titles_text
           || ' ' || chr(10) || ' ' || meta_text)), '{TOKEN_SQL}') AS k
  FROM a JOIN views ON id = item_id),
grams AS (
  SELECT id, cluster_id, unnest(list_concat(k,
    list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i+1]))) AS term FROM k),
tf AS (SELECT id, cluster_id, term, count(*) AS tf FROM grams GROUP BY ALL),
total AS (SELECT count(*) AS n FROM a),
freq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (
  SELECT id, cluster_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w
  FROM tf JOIN freq USING (term) CROSS JOIN total WHERE df <= 0.9 * n),
unit AS (SELECT cluster_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw),
sizes AS (
  SELECT cluster_id, count(*) AS size, avg(s) AS avg_sim FROM a GROUP BY cluster_id),
weighed AS (
  SELECT cluster_id, term, round(sum(w) / any_value(size), 12) AS weight
  FROM unit JOIN sizes USING (cluster_id) GROUP BY cluster_id, term),
best AS (
  SELECT cluster_id, term, row_number() OVER (PARTITION BY cluster_id ORDER BY weight DESC, term) AS r
  FROM weighed QUALIFY r <= 8),
near AS (
  SELECT cluster_id, id, row_number() OVER (PARTITION BY cluster_id ORDER BY s DESC, id) AS r FROM a
  QUALIFY r <= 3),
lists AS (
  SELECT cluster_id, '["' || string_agg(term, '","' ORDER BY r) || '"]' AS top_terms
  FROM best GROUP BY cluster_id),
ids AS (
  SELECT cluster_id, '["' || string_agg(CAST(id AS VARCHAR), '","' ORDER BY r) || '"]' AS exemplars
  FROM near GROUP BY cluster_id)
SELECT cluster_id, size, round(avg_sim, 9) AS avg_sim, g AS major_group, round(pct, 6) AS purity,
       top_terms, exemplars
FROM sizes JOIN major USING (cluster_id) JOIN lists USING (cluster_id) JOIN ids USING (cluster_id)""",
    "global_report": f"""
WITH {_ASSIGNED_SQL}, {_DISTRIBUTION_SQL},
sizes AS (SELECT cluster_id, count(*) AS size, avg(s) AS avg_sim FROM a GROUP BY cluster_id)
SELECT count(*) AS clusters, CAST(sum(size) AS BIGINT) AS total_items,
       round(avg(size), 6) AS avg_cluster_size, round(avg(pct), 6) AS mean_purity,
       round(avg(avg_sim), 6) AS mean_avg_sim
FROM sizes JOIN major USING (cluster_id)""",
    "size_balance": f"""
WITH {_ASSIGNED_SQL}, sizes AS (SELECT count(*) AS n FROM a GROUP BY cluster_id),
total AS (SELECT sum(n) AS t, count(*) AS clusters FROM sizes)
SELECT clusters, CAST(t AS BIGINT) AS total,
       (SELECT round(1 - sum((n / t) * (n / t)), 6) FROM sizes) AS size_balance
FROM total""",
    "cluster_sizes": f"""
WITH {_ASSIGNED_SQL} SELECT cluster_id, count(*) AS size FROM a GROUP BY cluster_id""",
    "tuning_trials": f"""
WITH {DOUBLES_SQL},
trials AS ({_trial_sql(4)} UNION ALL {_trial_sql(6)} UNION ALL {_trial_sql(8)}),
scored AS (
  SELECT *, 0.5 * purity + 0.3 * (silhouette + 1) / 2 + 0.2 * size_balance AS score FROM trials)
SELECT k, round(purity, 6) AS purity, round(silhouette, 6) AS silhouette,
       round(size_balance, 6) AS size_balance, round(score, 6) AS score,
       row_number() OVER (ORDER BY score DESC, k) = 1 AS best
FROM scored""",
}
# Queries that must give what another one gives.
ORACLES = {name: ORACLES.get(sql, sql) for name, sql in ORACLES.items()}
