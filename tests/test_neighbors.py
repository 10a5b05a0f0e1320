from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from planted import brute_force, planted, table
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith import session
from catalith.operators import evaluate, knn, pairwise
from catalith.operators.cluster import kmeans
from catalith.sources import readers, writers

COLUMNS = ["query_id", "candidate_id", "candidate_group", "score", "rank"]


def found(df):
    return sorted(
        (r[0], r[1], r[2], round(r[3], 6) + 0.0, r[4]) for r in df.select(*COLUMNS).collect()
    )


def with_copies():
    """A third of all rows share one vector."""
    ids, labels, x = planted(5, 18)
    x[:30] = x[0]
    return ids, labels, x


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("make", [planted, with_copies])
def test_all_plans_agree_with_brute_force(spark, make, metric):
    ids, labels, x = make()
    catalog = table(spark, ids, labels, x)
    want = brute_force(ids, labels, x, 4, metric)
    for plan in ("auto", "right", "left", "blocks"):
        got = knn.nearest(catalog, catalog, 4, metric, True, plan=plan, block_rows=25)
        assert found(got) == want, plan


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(spark):
    return sum(len(paths) for paths in session._written.values())


def test_plan_follows_the_sizes(spark):
    catalog = table(spark, *planted(4, 10))
    few = catalog.limit(2)

    def operators(queries, limit):
        before = written(spark)
        out = knn.nearest(queries, catalog, 3, broadcast_bytes=limit)
        plan = executed(out)
        return "MapInArrow" in plan, "Window" in plan, written(spark) - before

    # One side is sent to the tasks and nothing is written; only two large sides write one of them.
    assert operators(few, 64 << 20) == (True, False, 0)
    assert operators(few, 16 * 8 * 3) == (True, True, 0)
    assert operators(catalog, 16 * 8 * 3) == (True, False, 1)


def test_two_large_sides_are_not_shuffled(spark):
    """No exchange and no copies of rows, however many pairs of blocks there are."""
    ids, labels, x = planted(6, 20)
    catalog = session.materialize(table(spark, ids, labels, x))
    out = knn.nearest(catalog, catalog, 4, "cosine", True, plan="blocks", block_rows=7)
    assert not any(word in executed(out) for word in ("Exchange", "Generate", "Join"))
    assert found(out) == brute_force(ids, labels, x, 4)


def test_cosine_divides_by_the_lengths(spark):
    ids, labels, x = planted(4, 10)
    lengths = np.random.default_rng(2).uniform(0.1, 9.0, len(x))[:, None]
    long_ = table(spark, ids, labels, x * lengths)
    assert found(knn.nearest(long_, long_, 4, "cosine", True)) == brute_force(ids, labels, x, 4)
    zero = table(spark, ["z"], [0], np.zeros((1, x.shape[1])))
    assert {r.score for r in knn.nearest(zero, long_, 3).collect()} == {0.0}


def stored(spark, catalog, path, k=6):
    cells = kmeans(catalog, k).withColumnRenamed("cluster_id", "cell_id")
    writers.write_cells(knn.assign_cells(catalog, cells), cells, path)
    return readers.read_cells(spark, path)


def test_a_search_reads_only_its_cells(spark, tmp_path):
    ids, labels, x = planted(8, 20)
    catalog = table(spark, ids, labels, x)
    path = str(tmp_path / "cells")
    members, cells = stored(spark, catalog, path, 8)
    before = written(spark)
    out = knn.nearest_in_cells(catalog.limit(1), members, cells, 3, nprobe=2)
    assert written(spark) == before
    plan = out._jdf.queryExecution().toString()
    pruned = re.search(r"PartitionFilters: \[[^]]*cell_id#\d+ IN \(([^)]*)\)", plan)
    assert pruned and len(pruned[1].split(",")) == 2
    assert out.count() == 3
    # Queries beyond the limit are dealt to their cells, whose files the tasks read.
    dealt = knn.nearest_in_cells(catalog, members, cells, 3, nprobe=2, broadcast_bytes=1, block_rows=9, stored=path)
    small = knn.nearest_in_cells(catalog, members, cells, 3, nprobe=2, block_rows=9)
    unstored = knn.nearest_in_cells(catalog, members, cells, 3, nprobe=2, broadcast_bytes=1)
    assert found(dealt) == found(small) == found(unstored)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("make", [lambda: planted(8, 25, noise=0.2), with_copies])
def test_bounds_give_the_exact_neighbours_with_fewer_candidates(spark, tmp_path, make, metric):
    ids, labels, x = make()
    catalog = session.materialize(table(spark, ids, labels, x))
    path = str(tmp_path / "cells")
    members, cells = stored(spark, catalog, path, 8)
    radii = knn.cell_radii(members, cells, metric)
    before = written(spark)
    out = knn.nearest_by_bounds(catalog, path, radii, 4, metric, exclude_self=True, block_rows=30)
    assert not any(word in executed(out) for word in ("Exchange", "Join")) and written(spark) == before
    assert found(out) == brute_force(ids, labels, x, 4, metric)
    compared = {r[0]: r[1] for r in out.select("query_id", "compared").distinct().collect()}
    assert sum(compared.values()) < 0.8 * len(ids) ** 2
    with pytest.raises(ValueError, match="triangle"):
        knn.nearest_by_bounds(catalog, path, radii, 4, "ip")


def test_bounds_on_odd_rows(spark, tmp_path):
    ids, labels, x = planted(3, 8)
    catalog = table(spark, ids, labels, x)
    holes = catalog.unionAll(catalog.limit(1).select(F.lit(None).cast("string"), "group_id", F.lit(None)))
    path = str(tmp_path / "cells")
    members, cells = stored(spark, catalog, path, 3)
    radii = knn.cell_radii(members, cells)
    assert knn.nearest_by_bounds(holes, path, radii, 100).count() == len(ids) ** 2
    assert knn.nearest_by_bounds(catalog.limit(0), path, radii, 2).count() == 0
    assert knn.nearest_by_bounds(catalog, path, radii.limit(0), 2).count() == 0


def test_recall_grows_with_the_probes(spark, tmp_path):
    ids, labels, x = planted(10, 20, noise=0.5)
    catalog = table(spark, ids, labels, x)
    members, cells = stored(spark, catalog, str(tmp_path / "cells"), 10)
    want = {r[:2] for r in brute_force(ids, labels, x, 5)}
    recall = []
    for nprobe in (1, 3, 10):
        got = {r[:2] for r in found(knn.nearest_in_cells(catalog, members, cells, 5, nprobe, exclude_self=True))}
        recall.append(len(got & want) / len(want))
    assert recall == sorted(recall) and recall[0] > 0.3 and recall[-1] == 1.0


def repeated(spark):
    """Four vectors, of which two share an id and one has none."""
    x = np.array([[1.0, 0.0], [0.9, 0.1], [0.0, 1.0], [0.1, 0.9]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return table(spark, ["a", None, "a", "b"], ["p", "p", "q", "q"], x)


def test_repeated_and_null_ids_stay_rows_of_their_own(spark):
    # A row without an id excludes nothing, so it finds itself.
    pairs = knn.nearest_pairs(repeated(spark)).select("item_id", "group_id", "nearest_id", "nearest_group").collect()
    assert sorted(map(tuple, pairs), key=repr) == sorted(
        [("a", "gp", None, "gp"), (None, "gp", None, "gp"), ("a", "gq", "b", "gq"), ("b", "gq", "a", "gq")], key=repr
    )
    metrics = evaluate.evaluate(repeated(spark), repeated(spark), 1).collect()
    assert [(r["metric"], r["value"], r["n"]) for r in metrics] == [("p", 1.0, 4)]


def test_rows_do_not_depend_on_order_or_partitions(spark):
    ids, labels, x = planted(4, 12)
    turn = np.random.default_rng(1).permutation(len(ids))
    a = table(spark, ids, labels, x, 1)
    b = table(spark, [ids[i] for i in turn], labels[turn], x[turn], 9)
    assert found(knn.nearest(a, a, 3)) == found(knn.nearest(b, b, 3))


def test_fewer_candidates_than_k_and_null_vectors(spark):
    catalog = table(spark, *planted(1, 3))
    assert knn.nearest(catalog, catalog, 10).count() == 9
    assert knn.nearest(catalog, catalog, 10, exclude_self=True).count() == 6
    holes = catalog.unionAll(catalog.limit(1).select(F.lit("none"), "group_id", F.lit(None)))
    assert knn.nearest(holes, holes, 10).count() == 9
    nothing = catalog.where("item_id = ''")
    assert knn.nearest(nothing, catalog, 2).count() == 0
    assert knn.nearest(catalog, nothing, 2).count() == 0


@pytest.mark.parametrize("make", [planted, with_copies])
def test_cells_with_all_probes_are_exact(spark, make):
    ids, labels, x = make()
    catalog = table(spark, ids, labels, x)
    cells = kmeans(catalog, 4).withColumnRenamed("cluster_id", "cell_id")
    n = cells.count()
    members = knn.assign_cells(catalog, cells)
    assert members.count() == len(ids)
    got = knn.nearest_in_cells(catalog, members, cells, 4, n, exclude_self=True, block_rows=10)
    assert found(got) == brute_force(ids, labels, x, 4)
    one = knn.nearest_in_cells(catalog, members, cells, 4, 1, exclude_self=True)
    assert 0 < one.count() <= 4 * len(ids)


def test_centers_beyond_the_broadcast_limit(spark):
    ids, labels, x = planted(4, 10)
    rows_ = table(spark, ids, labels, x)
    centers = rows_.select(F.substring("item_id", 2, 4).cast("int").alias("cluster_id"), F.col("embedding").alias("centroid"))
    small = knn.attach_nearest(rows_, centers, 2)
    large = knn.attach_nearest(rows_, centers, 2, broadcast_bytes=1)
    names = ["item_id", "group_id", "cluster_id", "score", "rank"]
    assert rows(small, *names) == rows(large, *names)
    assert small.columns == ["item_id", "group_id", "embedding", "cluster_id", "score", "rank"]


def test_nearest_pairs_stay_in_their_group(spark):
    ids, labels, x = planted()
    pairs = knn.nearest_pairs(table(spark, ids, labels, x)).collect()
    assert len(pairs) == len(ids)
    assert all(p["group_id"] == p["nearest_group"] and p["item_id"] != p["nearest_id"] for p in pairs)


def test_retrieval_metrics_by_hand(spark):
    queries = spark.createDataFrame(
        [("a", "x", "en"), ("b", "y", "fr"), ("c", "z", None)],
        "item_id string, group_id string, lang string",
    )
    neighbors = spark.createDataFrame(
        [
            ("a", "1", "x", 0.9, 1), ("a", "2", "y", 0.8, 2), ("a", "3", "x", 0.7, 3),
            ("b", "1", "x", 0.9, 1), ("b", "2", "y", 0.8, 2),
        ],
        "query_id string, candidate_id string, candidate_group string, score double, rank int",
    )
    got = {
        (r["slice"], r["metric"], r["k"]): (round(r["value"], 6), r["n"])
        for r in evaluate.retrieval_metrics(neighbors, queries, 3, "lang").collect()
    }
    ap_a, ap_b = (1 + 2 / 3) / 2, 1 / 2
    assert got == {
        ("all", "p", 1): (0.5, 3),
        ("all", "p", 3): (0.6, 3),
        ("all", "map", 3): (round((ap_a + ap_b + 0) / 3, 6), 3),
        ("en", "p", 1): (1.0, 1),
        ("en", "p", 3): (round(2 / 3, 6), 1),
        ("en", "map", 3): (round(ap_a, 6), 1),
        ("fr", "p", 1): (0.0, 1),
        ("fr", "p", 3): (0.5, 1),
        ("fr", "map", 3): (0.5, 1),
    }


def test_planted_groups_are_found_again(spark):
    catalog = table(spark, *planted())
    metrics = evaluate.evaluate(catalog, catalog, 5).collect()
    assert {(r["metric"], r["k"]) for r in metrics} == {("p", 1), ("p", 3), ("p", 5), ("map", 3), ("map", 5)}
    assert all(r["value"] == 1.0 and r["n"] == 120 for r in metrics)
    with pytest.raises(ValueError, match="group_id"):
        evaluate.evaluate(catalog.drop("group_id"), catalog)


@pytest.mark.parametrize("plan", ["right", "left"])
def test_a_given_plan_goes_over_to_blocks_beyond_the_limit(spark, plan):
    ids, labels, x = planted(4, 12)
    catalog = table(spark, ids, labels, x)
    got = knn.nearest(catalog, catalog, 4, exclude_self=True, plan=plan, broadcast_bytes=1)
    assert found(got) == brute_force(ids, labels, x, 4)


def test_small_blocks_are_filled_up(spark, monkeypatch):
    """The right table is not read once for every few left rows."""

    class LeftSizes:
        """Kernel that tells how many left rows came together."""

        def prepare(self, right):
            return None

        def compare(self, left, prepared, so_far=None):
            return left.select([pairwise.LEFT_ROW]).append_column("n", pa.array([len(left)] * len(left)))

        def merge(self, partial):
            return partial.slice(0, len(partial) // 2)

    left = table(spark, *planted(4, 25)).select("embedding").coalesce(1)
    right = left.withColumnRenamed("embedding", "other")

    def sizes():
        schema = T.StructType([T.StructField("n", T.LongType())])
        out, _ = pairwise.pairwise(left, right, LeftSizes(), schema, "embedding", "other", "blocks", block_rows=7)
        return {r.n for r in out.collect()}

    # Read in small batches, which a block gathers.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert sizes() == {100}
        monkeypatch.setattr(pairwise, "LEAST_ROWS", 1)
        assert max(sizes()) < 20
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_estimates_lose_no_hit(monkeypatch, metric):
    """Copies, zero rows, excluded ranges, lengths far from 1, and a score to beat."""
    monkeypatch.setattr(knn, "_TILE_ROWS", 16)
    monkeypatch.setattr(knn, "_TILE_COLUMNS", 64)
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(90, 12)), rng.normal(size=(700, 12))
    c[100:300], c[400:420], q[5:8], q[20:40] = c[5], 0.0, 0.0, c[5]
    for scale in (1.0, 1e-6, 1e3):
        a, b = (knn.unit_rows(q), knn.unit_rows(c)) if metric == "cosine" else (q * scale, c * scale)
        ranges = np.sort(rng.integers(0, len(c) + 1, size=(len(q), 2)), axis=1)
        for k in (1, 5, 1000):
            for blocked in ((), ranges):
                want, got = knn.top_columns(a, b, k, metric, blocked), knn.best_columns(a, b, k, metric, blocked)
                assert all((x == y).all() for x, y in zip(want[:2], got[:2], strict=True))
                assert np.allclose(want[2], got[2], rtol=1e-12, atol=1e-9)
        rows_, _, scores = knn.best_columns(a, b, 3, metric)
        least = scores[2::3]
        again = knn.best_columns(a, b, 3, metric, (), least)
        assert (again[2] == scores).all() and (again[0] == rows_).all()
        assert not len(knn.best_columns(a, b, 3, metric, (), least + 1e9)[0])


def test_rows_with_hits_elsewhere_look_for_better_ones_only(monkeypatch):
    """Such rows begin with the score that they have, and tiles without a hit are not sorted."""
    rng = np.random.default_rng(8)
    c = knn.unit_rows(rng.normal(size=(300, 5)).astype(np.float32).astype(float))
    q = c[:40]
    monkeypatch.setattr(knn, "_TILE_ROWS", 16)
    monkeypatch.setattr(knn, "_TILE_COLUMNS", 64)
    for blocked in ((), np.stack([np.arange(40), np.arange(40) + 1], axis=1)):
        rows_, cols, scores = knn.best_columns(q, c, 4, "cosine", blocked)
        want = knn.top_columns(q, c, 4, "cosine", blocked)
        assert all((a == b).all() for a, b in zip((rows_, cols, scores), want, strict=True))
        calls, sort = [], np.partition
        with monkeypatch.context() as patch:
            patch.setattr(np, "partition", lambda *a, **b: calls.append(a) or sort(*a, **b))
            again = knn.best_columns(q, c, 4, "cosine", blocked, scores.reshape(40, 4)[:, 3])
        assert all((a == b).all() for a, b in zip(again, want, strict=True)) and not calls
