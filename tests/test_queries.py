"""Every named query against its SQL on the smallest of the given data."""

from __future__ import annotations

import os

import duckdb
import pytest

import workload

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def plain(value):
    return float(value) + 0.0 if isinstance(value, float) or hasattr(value, "is_finite") else value


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(workload.ORACLES))
def test_query_agrees_with_sql(spark, database, name):
    df = workload.QUERIES[name](spark, FOLDER)
    result = database.execute(workload.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.collect(), df.columns) == ordered(result.fetchall(), columns)


def test_only_the_search_lacks_sql():
    assert set(workload.QUERIES) - set(workload.ORACLES) == {"tuning_grid"}


def test_the_flagship_scan_prunes_by_the_scope(spark):
    df = workload.QUERIES["scope_views"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "RoundRobinPartitioning" not in plan


def test_languages_of_every_document(spark, database):
    """Neither the query nor its SQL leaves documents out."""
    every = {r[0] for r in database.execute("SELECT doc_id FROM documents").fetchall()}
    assert {r.item_id for r in workload.QUERIES["language_detect"](spark, FOLDER).collect()} == every
    assert {r[0] for r in database.execute(workload.ORACLES["language_detect"]).fetchall()} == every
