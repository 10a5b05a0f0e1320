from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from planted import planted, table
from pyspark.sql import functions as F

from catalith import session
from catalith.operators import assign, cluster, encode, quality, report, terms
from catalith.plans import clusters as plans


def centroid_table(spark, centers):
    data = [(i, [float(v) for v in c]) for i, c in enumerate(centers)]
    return spark.createDataFrame(data, "cluster_id int, centroid array<double>")


def silhouette(labels, x):
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))


def davies_bouldin(labels, x):
    names = sorted(set(labels))
    c = np.array([x[labels == n].mean(0) for n in names])
    s = [np.linalg.norm(x[labels == n] - c[i], axis=1).mean() for i, n in enumerate(names)]
    worst = [
        max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(c)) if j != i)
        for i in range(len(c))
    ]
    return float(np.mean(worst))


def labelled(spark, labels, x, partitions=3):
    ids = [f"i{n}" for n in range(len(labels))]
    return table(spark, ids, labels, x, partitions).withColumn(
        "cluster_id", F.substring("group_id", 2, 9).cast("int")
    )


@pytest.mark.parametrize("algorithm", ["kmeans", "minibatch"])
@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_planted_clusters_are_recovered(spark, algorithm, metric):
    ids, labels, x = planted(5, 30, noise=0.01)
    catalog = table(spark, ids, labels, x)
    assignments, centroids = plans.cluster_catalog(
        catalog, 5, algorithm, metric=metric, batch_size=64, n_init=2
    )
    assert assignments.columns == ["item_id", "group_id", "cluster_id", "sim_to_centroid"]
    found = rows(report.majority_groups(report.group_distribution(assignments)))
    assert [f[2] for f in found] == [1.0] * 5
    norms = [np.linalg.norm(r["centroid"]) for r in centroids.collect()]
    assert np.allclose(norms, 1.0)
    assert assignments.where("sim_to_centroid < 0.9").count() == 0


def test_lloyd_step_against_numpy(spark):
    _, labels, x = planted(4, 25, noise=0.5)
    start = x[[0, 30, 60, 90]].astype(np.float64)
    step = cluster.lloyd_step(labelled(spark, labels, x, 7), centroid_table(spark, start))
    best = np.linalg.norm(x[:, None] - start[None], axis=2).argmin(1)
    for r in step.collect():
        mine = x[best == r["cluster_id"]].astype(np.float64)
        assert r["n"] == len(mine)
        assert np.allclose(r["centroid"], mine.mean(0), atol=1e-9)


def test_assignment_threshold_ties_and_missing_ids(spark):
    items = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.6, 0.8]), ("c", [-1.0, 0.0])], "item_id string, embedding array<float>"
    )
    centers = centroid_table(spark, [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0]])
    got = assign.assign_new(items, centers, 0.8)
    assert [(r[0], r[1], round(r[2], 6), r[3]) for r in sorted(got.collect())] == [
        ("a", 0, 1.0, 1), ("b", 1, 0.8, 1), ("c", -1, 0.0, 1),
    ]
    assert rows(assign.assign_new(items, centers), "assigned_cluster") == [(0,), (1,), (1,)]
    numbered = assign.assign_new(items.coalesce(1), centers, id_column=None)
    assert rows(numbered, "item_id") == [("0",), ("1",), ("2",)]


def test_label_disagreement(spark):
    items = spark.createDataFrame(
        [("a", "g", [1.0, 0.1]), ("b", "g", [0.0, 1.0])], "item_id string, group_id string, embedding array<float>"
    )
    centers = centroid_table(spark, [[9.0, 0.0], [0.4, 0.8]])
    assert rows(cluster.label_disagreement(items, centers)) == [(2, 1)]
    assert rows(cluster.label_disagreement(items, centroid_table(spark, [[1.0, 0.0], [0.0, 1.0]]))) == [(2, 0)]


@pytest.mark.parametrize("plan", ["right", "blocks"])
def test_quality_against_numpy(spark, plan):
    _, labels, x = planted(4, 15, noise=0.6)
    labels = labels.copy()
    labels[0], x[20:40] = 9, x[20]  # a cluster of one, and many copies
    members = labelled(spark, labels, x)
    x = x.astype(np.float64)
    got = quality.silhouette(members, plan=plan, block_rows=20).head()
    assert (got["n"], got["clusters"]) == (60, 5)
    assert got["silhouette"] == pytest.approx(silhouette(labels, x), abs=1e-7)
    found = quality.davies_bouldin(members, plan=plan).head()
    assert found["davies_bouldin"] == pytest.approx(davies_bouldin(labels, x), abs=1e-9)


def test_quality_of_one_cluster(spark):
    _, labels, x = planted(1, 5)
    assert rows(quality.cluster_quality(labelled(spark, labels, x))) == [(5, 16, 1, -1.0, -1.0)]


def test_size_balance(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "cluster_id int")
    assert rows(cluster.size_balance(df)) == [(2, 4, 1 - (9 + 1) / 16)]
    assert rows(cluster.size_balance(df.where("cluster_id = 0"))) == [(1, 3, 0.0)]
    assert rows(cluster.size_balance(df.where("cluster_id = 7"))) == [(0, 0, 0.0)]


ASSIGNED = [
    ("a", "g1", 0, 0.9), ("b", "g1", 0, 0.8), ("c", "g2", 0, 0.9), ("d", None, 0, 0.1),
    ("e", "g2", 1, 0.5), ("f", "g1", 1, 0.5), ("h", None, 2, 0.4),
]


def test_report_tables(spark):
    assigned = spark.createDataFrame(
        ASSIGNED, "item_id string, group_id string, cluster_id int, sim_to_centroid double"
    )
    views = spark.createDataFrame(
        [(i, f"pump pump w{i}", "red valve" if c == 0 else "", "8") for i, _, c, _ in ASSIGNED[:-1]],
        "item_id string, title_text string, chap_titles_text string, meta_text string",
    )
    found = report.cluster_report(assigned, views, top_terms=3)
    assert rows(found["distribution"]) == [
        (0, "g1", 2, 0.5), (0, "g2", 1, 0.25), (0, None, 1, 0.25),
        (1, "g1", 1, 0.5), (1, "g2", 1, 0.5), (2, None, 1, 1.0),
    ]
    summary = {r["cluster_id"]: r for r in found["summary"].collect()}
    assert [summary[c]["major_group"] for c in range(3)] == ["g1", "g1", None]
    assert [summary[c]["purity"] for c in range(3)] == [0.5, 0.5, 1.0]
    assert [summary[c]["size"] for c in range(3)] == [4, 2, 1]
    assert [summary[c]["exemplars"] for c in range(3)] == [["a", "c", "b"], ["e", "f"], ["h"]]
    assert summary[0]["top_terms"] == ["pump", "red", "red valve"]
    assert summary[2]["top_terms"] == []
    total = found["report"].head()
    assert (total["clusters"], total["total_items"]) == (3, 7)
    assert total["mean_purity"] == pytest.approx(2 / 3)
    assert total["avg_cluster_size"] == pytest.approx(7 / 3)


def model_tfidf(docs, max_df):
    counts = []
    for words in docs:
        grams = words + [" ".join(p) for p in zip(words, words[1:])]
        counts.append({g: grams.count(g) for g in grams})
    n = len(docs)
    df = {}
    for c in counts:
        for g in c:
            df[g] = df.get(g, 0) + 1
    out = []
    for c in counts:
        raw = {g: t * (np.log((1 + n) / (1 + df[g])) + 1) for g, t in c.items() if df[g] <= max_df * n}
        norm = np.sqrt(sum(w * w for w in raw.values()))
        out.append({g: w / norm for g, w in raw.items()})
    return out


@pytest.mark.parametrize(("limit", "task_rows"), [(64 << 20, 0), (0, 0), (0, 1000)])
def test_tfidf_with_hot_terms_and_bigrams(spark, monkeypatch, limit, task_rows):
    """Terms sent to the tasks, looked up with hot ones apart, and joined."""
    monkeypatch.setattr("catalith.operators.terms.BROADCAST_BYTES", limit)
    monkeypatch.setattr("catalith.operators.terms._TOKENS", 15)
    monkeypatch.setattr("catalith.operators.lookup.HOT_ROWS", 4)
    monkeypatch.setattr("catalith.operators.lookup.TASK_ROWS", task_rows)
    rng = np.random.default_rng(3)
    docs = [["common"] * 2 + [f"w{x}" for x in rng.integers(0, 12, 8)] for _ in range(20)]
    for d in docs[:5]:
        d += ["planted", "pair"]
    docs[7] = ["other"]
    corpus = spark.createDataFrame(
        [(f"d{i:02}", int(i >= 5), " ".join(d)) for i, d in enumerate(docs)],
        "item_id string, cluster_id int, text string",
    ).repartition(3)
    want = model_tfidf(docs, 0.9)
    got = {}
    for r in terms.tfidf(corpus).collect():
        got.setdefault(r["item_id"], {})[r["term"]] = r["weight"]
    for i, weights in enumerate(want):
        assert got.get(f"d{i:02}", {}) == pytest.approx(weights)
    assert "common" not in got["d00"]
    best = {(r["cluster_id"], r["rank"]): r["term"] for r in terms.cluster_terms(corpus, 3).collect()}
    assert {best[0, 1], best[0, 2], best[0, 3]} == {"pair", "planted", "planted pair"}


def test_terms_of_odd_rows(spark):
    """Rows without a text, of one token, and that share an id or have none."""
    texts = [("a", None), ("a", "one two one two"), (None, "two three"), (None, "one"), ("b", ""), ("b", "x1 x1 x1")]
    corpus = spark.createDataFrame([(0, i, t) for i, t in texts], "cluster_id int, item_id string, text string")
    counts = sorted((r.item_id or "", r.term, r.tf) for r in terms.term_counts(corpus, ["item_id"], ngram_max=3).collect())
    assert counts == sorted([
        ("a", "one", 2), ("a", "two", 2), ("a", "one two", 2), ("a", "two one", 1), ("a", "one two one", 1), ("a", "two one two", 1),
        ("", "two", 1), ("", "three", 1), ("", "two three", 1), ("", "one", 1), ("b", "x1", 3), ("b", "x1 x1", 2), ("b", "x1 x1 x1", 1),
    ])
    weights = terms.tfidf(corpus).groupBy("item_id", F.lit(1)).agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    # Each row has a norm of its own, also where the id repeats or is null.
    assert {r.item_id: round(r.n, 9) for r in weights} == {"a": 1.0, None: 2.0, "b": 1.0}
    assert terms.tfidf(corpus.limit(0)).count() == 0 and terms.cluster_terms(corpus.limit(0)).count() == 0


def test_one_shuffle_of_terms(spark):
    """Neither tokens nor terms are shuffled by item."""
    corpus = spark.createDataFrame([(0, "a", "one two")], "cluster_id int, item_id string, text string")
    plan = terms.cluster_terms(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "hashpartitioning(item_id" not in plan
    assert plan.count("Exchange hashpartitioning") == 2  # by cluster and term, and the top terms by cluster


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_cluster_terms_are_those_of_all_rows(spark, monkeypatch, limit):
    """Neither pieces nor sums that are left out change the best terms; terms are not shuffled by row."""
    monkeypatch.setattr(terms, "BROADCAST_BYTES", limit)
    for name, value in (("_COUNTED", 40), ("_HELD", 300), ("_LOOKED_UP", 90), ("_READ", 3)):
        monkeypatch.setattr(terms, name, value)
    rng = np.random.default_rng(11)
    docs = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 30)) % 300) for _ in range(150)]
    rows_ = [(None if i % 31 == 0 else int(rng.integers(0, 4)), i, None if i % 37 == 0 else d) for i, d in enumerate(docs)]
    corpus = spark.createDataFrame([*rows_, (9, 200, "alone here")], "cluster_id int, item_id int, text string").repartition(3)
    found = terms.cluster_terms(corpus, 5, ngram_max=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 2
    got = {(r.cluster_id, r["rank"]): (r.term, pytest.approx(r.weight)) for r in found.collect()}
    sums, sizes = {}, {}
    for r in corpus.collect():
        sizes[r.cluster_id] = sizes.get(r.cluster_id, 0) + 1
    for r in terms.tfidf(corpus, ["cluster_id"], ngram_max=3).collect():
        sums.setdefault(r.cluster_id, {}).setdefault(r.term, []).append(r.weight)
    want = {}
    for cluster, weights in sums.items():
        means = {t: round(sum(w) / sizes[cluster], 12) for t, w in weights.items()}
        for rank, t in enumerate(sorted(means, key=lambda t: (-means[t], t))[:5], 1):
            if cluster is not None:
                want[cluster, rank] = (t, means[t])
    assert got == want


def test_digests_that_agree_in_one_half_are_apart():
    high = np.array([5, 5, 7, 5, 9], dtype=np.uint64)
    low = np.array([1, 2, 1, 1, 3], dtype=np.uint16)
    held = terms._added(high, low, np.array([2, 3, 4, 5, 6]))
    assert [x.tolist() for x in held] == [[5, 5, 7, 9], [1, 2, 1, 3], [7, 3, 4, 6]]
    wanted = np.array([9, 5, 5, 5, 6, 7], dtype=np.uint64), np.array([3, 2, 1, 4, 0, 2], dtype=np.uint16)
    assert terms._Frequencies("", held).find(*wanted).tolist() == [6, 3, 7, 1, 1, 1]


def test_grid_and_best_trial(spark):
    assert plans.parameter_grid([4, 6]) == [
        (4, 2.0, 1.0, 0.5), (4, 2.0, 1.0, 0.0), (4, 2.0, 1.5, 0.5), (4, 2.0, 1.5, 0.0),
        (6, 2.0, 1.0, 0.5), (6, 2.0, 1.0, 0.0), (6, 2.0, 1.5, 0.5), (6, 2.0, 1.5, 0.0),
    ]
    with pytest.raises(ValueError):
        plans.parameter_grid([])
    trials = spark.createDataFrame(
        [(8, 2.0, 1.0, 0.5, 0.7), (4, 2.0, 1.5, 0.5, 0.9), (4, 2.0, 1.0, 0.5, 0.9)],
        "k int, w_title double, w_chaps double, w_meta double, score double",
    )
    assert rows(plans.best_trial(trials)) == [(4, 2.0, 1.0, 0.5, 0.9)]
    score = spark.range(1).select(plans.tuning_score(F.lit(0.8), F.lit(0.5), F.lit(0.25)))
    assert score.head()[0] == pytest.approx(0.5 * 0.8 + 0.3 * 0.75 + 0.2 * 0.25)


def test_quality_carries_the_settings_of_the_fit(spark):
    rows_ = [(i, i % 2, [float(i % 2), float(i)]) for i in range(6)]
    assigned = spark.createDataFrame(rows_, "item_id long, cluster_id int, embedding array<double>")
    found = quality.cluster_quality(assigned, k=2, algorithm="kmeans", seed=7).first().asDict()
    assert (found["n"], found["k"], found["algorithm"], found["seed"]) == (6, 2, "kmeans", 7)


def test_squared_silhouette_of_single_items(spark):
    rows_ = [(0, 0, [0.0, 0.0]), (1, 0, [0.0, 2.0]), (2, 1, [4.0, 0.0])]
    assigned = spark.createDataFrame(rows_, "item_id long, cluster_id int, embedding array<double>")
    found = quality.silhouette_squared(assigned).first()
    assert (found["n"], found["clusters"]) == (3, 2)
    assert found["silhouette"] == pytest.approx(((16 - 4) / 16 + (20 - 4) / 20 + 0) / 3)
    assert quality.silhouette_squared(assigned.where("cluster_id = 0")).first()["silhouette"] == -1.0


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_a_fit_by_tables_costs_no_more_than_a_fit_in_memory(spark, metric):
    """Planted groups with far outliers: within a tenth of the cost of the library's fit."""
    _, labels, x = planted(8, 30, noise=0.15)
    rng = np.random.default_rng(5)
    x = np.concatenate([x, 3 * rng.normal(size=(6, x.shape[1]))]).astype(np.float32)
    catalog = table(spark, [f"i{i}" for i in range(len(x))], np.append(labels, [9] * 6), x)

    def cost(centroids):
        c = np.array([r["centroid"] for r in centroids.collect()])
        y = x.astype(float)
        if metric == "cosine":
            y, c = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (y, c))
        assert len(c) == 10
        return ((y[:, None] - c[None]) ** 2).sum(2).min(1).sum()

    in_memory = min(cost(cluster.kmeans(catalog, 10, seed=s, metric=metric, max_iter=20)) for s in (1, 2))
    by_tables = cost(cluster.kmeans(catalog, 10, seed=3, metric=metric, max_iter=8, broadcast_bytes=1))
    assert by_tables <= 1.1 * in_memory


def test_the_best_trial_is_fitted_again(spark):
    """Vectors of certain groups: the clusters of the best trial are those it was measured on."""
    _, labels, x = planted(4, 10, noise=0.02)
    ids = [f"i{i}" for i in range(len(x))]
    made = table(spark, ids, labels, x)
    grid = [(2, 2.0, 1.0, 0.5), (4, 2.0, 1.0, 0.5)]
    options = {"make_catalog": lambda views, weights: made, "max_iter": 10, "n_init": 2}
    trials = plans.tune(made, grid, silhouette="squared", **options)
    exact = plans.tune(made, grid, **options)
    assert plans.best_trial(trials).first()["k"] == plans.best_trial(exact).first()["k"] == 4
    assignments, centroids = plans.best_clusters(made, trials, **options)
    assert centroids.count() == 4
    pairs = {(r["group_id"], r["cluster_id"]) for r in assignments.collect()}
    assert len(pairs) == 4 and assignments.count() == len(ids)
    with pytest.raises(ValueError, match="silhouette"):
        plans.tune(made, grid, silhouette="none", **options)


def _tables(spark):
    return sum(len(paths) for paths in session._written.values())


def test_texts_and_terms_are_written_once(spark, monkeypatch):
    """The corpus of a report is not written, and terms beyond the broadcast limit are not written again."""
    texts = [(0, "a", "one two two"), (0, "b", "two three"), (1, "c", "three one"), (1, None, "four three")]
    corpus = spark.createDataFrame(texts, "cluster_id int, item_id string, text string")

    def found(df):
        return sorted((r.item_id or "", r.term, round(r.weight, 9)) for r in df.collect())

    small = found(terms.tfidf(corpus))
    monkeypatch.setattr(terms, "BROADCAST_BYTES", 0)
    before = _tables(spark)
    large = terms.tfidf(corpus)
    assert _tables(spark) - before == 3  # terms of the rows, terms of two rows or more, frequencies
    assert found(large) == small
    monkeypatch.undo()
    assignments = corpus.select("cluster_id", "item_id", F.lit("g").alias("group_id"), F.lit(1.0).alias("sim_to_centroid"))
    views = corpus.select("item_id", F.col("text").alias("title_text"), F.lit("").alias("chap_titles_text"), F.lit("").alias("meta_text"))
    before = _tables(spark)
    report.cluster_report(assignments, views)
    assert _tables(spark) - before == 5  # terms of the rows, of two rows or more, sizes, top terms, summary


def test_silhouettes_of_blocks_compare_each_pair_once(spark, monkeypatch):
    """Pairs of many small blocks, two labellings at once: as NumPy has it."""
    _, labels, x = planted(5, 30, noise=0.4)
    labels, other = labels.copy(), np.arange(len(x)) % 3
    labels[0], x[40:60] = 9, x[40]  # a cluster of one, and many copies
    x[60:90] += 7.0  # a cluster far from the others, whose members bounds rule out
    ids = [None if i % 4 == 0 else f"i{i % 7}" for i in range(len(x))]
    number = F.substring("group_id", 2, 9).cast("int")
    members = table(spark, ids, labels, x).withColumn("cluster_id", number)
    both = table(spark, ids, labels * 10 + other, x).select(
        F.floor(number / 10).cast("int").alias("first"), (number % 10).alias("second"), "embedding"
    )
    monkeypatch.setattr(quality, "PAIR_BYTES", 20 * 8 * x.shape[1])
    x = x.astype(np.float64)
    expected = [silhouette(labels, x), silhouette(other, x)]
    assert quality.silhouettes(both, ["first", "second"]) == pytest.approx(expected, abs=1e-9)
    monkeypatch.setattr(quality, "pairwise", None)  # no table is broadcast, and none is read whole
    found = quality.silhouette_by_item(members)
    assert found.count() == len(x) and found.where("item is null").count() == sum(i is None for i in ids)
    assert quality.silhouette(members).head()["silhouette"] == pytest.approx(expected[0], abs=1e-9)
    monkeypatch.undo()
    monkeypatch.setattr(quality, "PAIR_GROUPS", 2)
    assert quality.silhouettes(both, ["first", "second"]) == pytest.approx(expected, abs=1e-9)


def test_tuning_compares_and_encodes_once_per_text(spark, monkeypatch):
    """All numbers of clusters of one text share one pass over its pairs, and all texts one encoding."""
    texts = [(str(i), f"g{i % 3}", f"Été pump {i % 3} -x", f"valve {i % 5} ΣΑΣ || y{i}", f"{i % 4} | qa") for i in range(30)]
    views = spark.createDataFrame(texts, "item_id string, group_id string, title_text string, chap_titles_text string, meta_text string")
    weights = [encode.TextWeights(2.0, 1.0, 0.5), encode.TextWeights(1.0, 3.0, 2.0)]
    found = encode.encode_weights(views, weights, 16)
    for i, w in enumerate(weights):
        single = encode.encode_items(views, w, dim=16)
        assert sorted(map(str, found.select("item_id", "group_id", f"embedding_{i}").collect())) == sorted(
            str(r).replace("embedding=", f"embedding_{i}=") for r in single.collect()
        )
    passes, compared = [], quality._compared
    monkeypatch.setattr(quality, "_compared", lambda rows, labellings, groups: passes.append(len(labellings)) or compared(rows, labellings, groups))
    grid = plans.parameter_grid([2, 3], w_chaps=[1.0, 3.0], w_meta=[0.5, 0.0])
    trials = plans.tune(views, grid, dim=16, max_iter=5).collect()
    assert passes == [2, 2] and [r["k"] for r in trials] == [k for k, *_ in grid]
