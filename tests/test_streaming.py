"""Streams of new items against the same items as one table."""

from __future__ import annotations

import numpy as np
from conftest import rows
from planted import planted, table

from catalith.operators import assign, knn
from catalith.operators.cluster import kmeans
from catalith.plans import stream
from catalith.sources import readers, writers


def arrivals(spark, folder, vectors):
    """The vectors as three files, and a stream that takes one file at a time."""
    for i, part in enumerate(np.array_split(np.arange(len(vectors[0])), 3)):
        ids, labels, x = vectors
        some = table(spark, [ids[j] for j in part], labels[part], x[part], 1)
        some.write.mode("append").parquet(f"{folder}/part{i}")
    schema = spark.read.parquet(f"{folder}/part0").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")


def test_streamed_assignment_is_that_of_the_table(spark, tmp_path):
    vectors = planted(4, 15)
    new_items = table(spark, *vectors)
    centroids = kmeans(new_items, 4)
    streamed = arrivals(spark, tmp_path / "in", vectors)
    paths = [str(tmp_path / name) for name in ("out", "checkpoint")]
    query = stream.assign_stream(streamed, centroids, *paths, threshold=0.9)
    query.awaitTermination(60)
    assert query.exception() is None and len(query.recentProgress) >= 3
    want = rows(assign.assign_new(new_items, centroids, 0.9))
    assert rows(spark.read.parquet(paths[0])) == want
    # A second run finds nothing new.
    stream.assign_stream(streamed, centroids, *paths, threshold=0.9).awaitTermination(60)
    assert rows(spark.read.parquet(paths[0])) == want


def test_streamed_neighbours_are_those_of_the_table(spark, tmp_path):
    catalog = table(spark, *planted(4, 15))
    vectors = planted(4, 9, noise=0.2, seed=42)
    new_items = table(spark, [f"new{i}" for i in vectors[0]], *vectors[1:])
    streamed = arrivals(spark, tmp_path / "in", ([f"new{i}" for i in vectors[0]], *vectors[1:]))
    cells = kmeans(catalog, 4).withColumnRenamed("cluster_id", "cell_id")
    writers.write_cells(knn.assign_cells(catalog, cells), cells, str(tmp_path / "cells"))
    members, cells = readers.read_cells(spark, str(tmp_path / "cells"))
    names = ["query_id", "candidate_id", "candidate_group", "score", "rank"]
    want = rows(knn.nearest(new_items, catalog, 3), *names)
    for name, source, options in (("exact", catalog, {}), ("cells", members, {"cells": cells, "nprobe": 4})):
        out, checkpoint = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-checkpoint")
        query = stream.neighbors_stream(streamed, source, out, checkpoint, k=3, **options)
        query.awaitTermination(90)
        assert query.exception() is None
        found = spark.read.parquet(out)
        assert rows(found, *names) == want and found.select("batch").distinct().count() == 3
