"""From views to neighbours, clusters and tuning, with stub encoders."""

from __future__ import annotations

import sys

import numpy as np
import pytest
from conftest import rows
from pyspark import cloudpickle

from catalith.operators import encode
from catalith.plans import catalog as plans
from catalith.plans.clusters import cluster_catalog, tune
from catalith import session
from catalith.session import clear_materialized, materialize, shared_folder, spread

# Workers cannot import this module, so the stub travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VIEWS = [
    ("b7", "bridges", "Cracked bearing plate", "Measured width", "14 | inspector"),
    ("b8", "bridges", "Cracked bearing seat", "Where it is", "3 | inspector"),
    ("t1", "tunnels", "Wet cable duct", "", "6 | foreman"),
    ("t2", "tunnels", "Dark lamp", "Source of the fault", "2 | clerk"),
]


class LengthEncoder:
    """A tiny stand-in for a model: length and first characters of a text."""

    def encode(self, texts):
        out = np.zeros((len(texts), 16))
        for row, t in zip(out, texts):
            row[:3] = len(t), sum(map(ord, t[:40])), len(set(t)) * 10
        return out


@pytest.fixture(scope="module")
def views(spark):
    names = "item_id string, group_id string, title_text string, chap_titles_text string, meta_text string"
    return spark.createDataFrame(VIEWS, names).repartition(2)


def test_plugged_encoder(spark, views):
    catalog = plans.build_catalog(views, make_encoder=LengthEncoder)
    assert rows(encode.catalog_shape(catalog)) == [(4, 16)]
    texts = {
        r["item_id"]: r["text"] for r in views.select("item_id", encode.TextWeights().text().alias("text")).collect()
    }
    for r in catalog.collect():
        want = encode.unit_rows(LengthEncoder().encode([texts[r["item_id"]]]))[0]
        assert np.allclose(r["embedding"], want, atol=1e-6)


def test_catalog_search_gives_k_rows_per_query(spark, views, tmp_path):
    catalog = plans.build_catalog(views, out=str(tmp_path / "catalog"))
    found = plans.find_neighbors(views, catalog, 3)
    assert found.columns == ["query_id", "candidate_id", "candidate_group", "score", "rank"]
    assert found.count() == 12
    best = {r["query_id"]: r["candidate_id"] for r in found.where("rank = 1").collect()}
    assert all(q == c for q, c in best.items())
    assert plans.find_neighbors(views, catalog, 9).count() == 16
    second = {r["query_id"]: r["candidate_id"] for r in found.where("rank = 2").collect()}
    assert second["b7"] == "b8"


def test_new_items_are_encoded_once(spark, views, tmp_path):
    log = tmp_path / "texts"

    class Logged(LengthEncoder):
        def encode(self, texts):
            with log.open("a") as out:
                out.write("x" * len(texts))
            return super().encode(texts)

    members, cells = plans.build_cells(plans.build_catalog(views, make_encoder=LengthEncoder), 2, str(tmp_path / "catalog"))
    for options in ({}, {"cells": cells, "nprobe": 2}):
        log.write_text("")
        assert plans.find_neighbors(views, members, 2, make_encoder=Logged, **options).count() == 8
        assert len(log.read_text()) == 4


def test_cells_on_disk(spark, views, tmp_path):
    catalog = plans.build_catalog(views)
    members, cells = plans.build_cells(catalog, 2, str(tmp_path / "cells"))
    assert members.count() == 4 and "cell_id" in members.columns
    found = plans.find_neighbors(views, members, 2, cells=cells, nprobe=2)
    assert rows(found) == rows(plans.find_neighbors(views, catalog, 2))


def test_hash_encoder(spark):
    df = spark.createDataFrame(
        [(1, "Pump failure"), (2, "failure PUMP title"), (3, ""), (4, None), (5, "x valve")],
        "i int, text string",
    )
    got = {r["i"]: np.array(r["embedding"]) for r in encode.hash_encode(df, dim=32).collect()}
    assert not np.array_equal(got[1], got[2]) and np.isclose(np.linalg.norm(got[1]), 1)
    assert not got[3].any() and not got[4].any()
    assert not np.array_equal(got[1], got[5])


def test_the_hash_encoder_reads_the_fields_and_not_their_labels(spark, views):
    word = views.limit(1).selectExpr("'a' AS item_id", "'title' AS title_text", "'' AS chap_titles_text", "'' AS meta_text")
    blank = word.selectExpr("'b' AS item_id", "'' AS title_text", "'' AS chap_titles_text", "'' AS meta_text")
    got = {r["item_id"]: np.array(r["embedding"]) for r in encode.encode_items(word.union(blank)).collect()}
    assert np.isclose(np.linalg.norm(got["a"]), 1) and not got["b"].any()


def test_new_items_get_clusters(spark, views):
    catalog = plans.build_catalog(views)
    assignments, centroids = cluster_catalog(catalog, 2)
    labels = dict(rows(assignments, "item_id", "cluster_id"))
    found = plans.assign_views(views, centroids)
    assert dict(rows(found, "item_id", "assigned_cluster")) == labels
    assert set(r[0] for r in rows(plans.assign_views(views, centroids, 1.1), "assigned_cluster")) == {-1}
    unnamed = plans.assign_views(views.drop("item_id"), centroids)
    assert unnamed.count() == 4 and unnamed.columns[0] == "item_id"


def test_weights_share_texts():
    w = encode.TextWeights
    assert w(meta=0.0).repeats() == w(meta=0.5).repeats() == w(meta=1.0).repeats()
    assert w(chapters=1.5).repeats() != w().repeats()


def test_tune_keeps_every_trial(spark, views):
    trials = tune(views, [(2, 2.0, 1.0, 0.5), (2, 2.0, 1.0, 0.0), (3, 2.0, 1.5, 0.5)], dim=32, max_iter=5)
    found = trials.collect()
    assert [r["k"] for r in found] == [2, 2, 3]
    assert found[0][4:] == found[1][4:]
    for r in found:
        assert r["score"] == pytest.approx(
            0.5 * r["purity"] + 0.3 * (r["silhouette"] + 1) / 2 + 0.2 * r["size_balance"]
        )
    with pytest.raises(ValueError):
        tune(views, [])


def test_materialize_uses_the_shared_folder(spark):
    df = spark.range(10).selectExpr("id", "id % 2 AS p")
    out = materialize(df, ["p"])
    assert rows(out) == rows(df) and out.columns == df.columns
    assert all(f.startswith(f"file://{shared_folder(spark)}") for f in out.inputFiles())
    assert materialize(df.where("id < 0")).count() == 0


def test_materialized_tables_can_be_cleared():
    class Session:
        """Stands for a session whose tables nobody reads."""

        def __init__(self):
            self.deleted = []
            self.sparkContext = self._jvm = self._jsc = self.org = self.apache = self.hadoop = self.fs = self

        def Path(self, name):
            self.name = name
            return self

        def hadoopConfiguration(self):
            return None

        def getFileSystem(self, _):
            return self

        def delete(self, path, deep):
            self.deleted.append((path.name, deep))

    own = Session()
    session._written[id(own)] = ["/a", "/b"]
    assert clear_materialized(own) == 2 and clear_materialized(own) == 0
    assert own.deleted == [("/a", True), ("/b", True)]


class Unset:
    """A session without the setting, on the given master."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, key, default):
        return default


def test_only_a_local_session_gets_a_folder_of_its_own():
    folder = shared_folder(Unset("local[2]"))
    assert folder == shared_folder(Unset("local[4]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset("yarn"))


def test_spread_leaves_large_inputs(spark):
    """The planner's estimate decides, so nothing runs."""
    large = spark.range(10**9)
    assert spread(large) is large
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == cores
