from __future__ import annotations

import pytest
from conftest import MASTER_ALIASES, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from catalith.operators import columns
from catalith.sources import contracts, readers, writers


def csv(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_text_pruned_and_quoted(spark, tmp_path):
    path = csv(tmp_path, 'A,B,EXTRA\n1,"x ""y"", z\nnext",9\n,NA,8\n')
    df = readers.read_csv(spark, path, keep=["a", "B"], aliases={"A": "a"})
    assert df.dtypes == [("A", "string"), ("B", "string")]
    assert rows(df) == sorted([("1", 'x "y", z\nnext'), (None, None)], key=repr)


def test_csv_long_and_short_rows(spark, tmp_path):
    path = csv(tmp_path, "a,b\n1,2\n1\n1,2,3\n")
    kept = readers.read_csv(spark, path, keep=["a", "b"])
    assert rows(kept) == sorted([("1", "2"), ("1", None), ("1", "2")], key=repr)
    strict = readers.read_csv(spark, path)
    assert rows(strict) == sorted([("1", "2"), ("1", None)], key=repr)


def test_csv_separator_and_encoding(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("a;b\né;2\n".encode("latin-1"))
    df = readers.read_any(spark, str(path), sep=";", encoding="iso-8859-1")
    assert rows(df) == [("é", "2")]


def test_aliases_and_missing_columns(spark):
    df = spark.createDataFrame([("1", "t")], ["ID", "TITLE"])
    df = columns.apply_aliases(df, {"ID": "item_id", "ABSENT": "x"})
    out = columns.project(df, ["scope", "item_id"])
    assert out.columns == ["scope", "item_id"] and rows(out) == [("", "1")]
    assert columns.apply_aliases(df, None) is df


def test_numbers(spark):
    texts = ["8", " 8.0 ", "1e3", "8.5", "8d", "inf", "nan", "", "x", None, "-2", "99999999999999999999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, n string")
    found = dict(rows(columns.to_int(df, "n")))
    assert [found[i] for i in range(len(texts))] == [
        8, 8, 1000, None, None, None, None, None, None, None, -2, None,
    ]


def test_contract_collects_all_failures(spark):
    chapters = spark.createDataFrame(
        [
            ("s", "g", "i", "1", "ok", None),
            (None, "g", "i", "0", "", "a"),
            ("s", "g", None, "1.5", None, "a"),
            ("s", "g", "i", "x", "ok", "a"),
        ],
        "scope string, group_id string, item_id string, chapter_number string, "
        "chapter_title string, attestation string",
    )
    found = dict(rows(contracts.violations(chapters, contracts.CHAPTERS)))
    assert found == {
        "scope.not_null": 1,
        "item_id.not_null": 1,
        "chapter_number.at_least_1": 1,
        "chapter_number.whole_number": 1,
        "chapter_number.not_null": 1,
        "chapter_title.min_length_1": 1,
        "chapter_title.not_null": 1,
    }
    with pytest.raises(contracts.ContractError) as error:
        contracts.enforce(chapters, contracts.CHAPTERS)
    assert error.value.counts == found


def test_null_workload_is_allowed_and_missing_title_is_not(spark, load, tmp_path):
    master, _ = load("1,G,I1,T,\n", "1,G,I1,1,C,\n")
    assert rows(master, "item_id", "workload") == [("I1", None)]
    path = csv(tmp_path, "FLEET,FAMILY,CARD\n1,G,I\n")
    with pytest.raises(contracts.ContractError, match="title.min_length_1"):
        readers.load_master(spark, path, aliases=MASTER_ALIASES)


def test_scope_limits_the_contract(load):
    master, chapters = load("1,G,I1,T,8\n2,G,I2,,x\n", "1,G,I1,1,C,\n2,G,I2,0,C,\n", scope="1")
    assert rows(master, "item_id") == [("I1",)] and rows(chapters, "item_id") == [("I1",)]


def test_duplicate_keys_and_required_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], ["k", "v"])
    assert rows(columns.duplicate_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        columns.require_columns(df, ["y", "k", "x"])


def test_filter_scope_counts_and_pushdown(spark, tmp_path):
    df = spark.createDataFrame([(" 1\t", "a"), ("1", "b"), ("2", "c"), (None, "d")], "scope string, v string")
    before, after = Observation(), Observation()
    kept = columns.filter_scope(df, "1", before=before, after=after)
    assert kept.columns == ["v"] and rows(kept) == [("a",), ("b",)]
    assert (before.get["n"], after.get["n"]) == (4, 2)
    assert columns.filter_scope(kept, "1") is kept
    writers.write_table(df.where("scope in ('1', '2')"), str(tmp_path / "t"), ["scope"])
    part = columns.filter_scope(spark.read.parquet(str(tmp_path / "t")), "2", trimmed=True)
    assert rows(part) == [("c",)]


def test_coalesce_suffixes(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "c")], "g_x string, g_y string")
    assert rows(columns.coalesce_suffixes(df, "g")) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        columns.coalesce_suffixes(df, "h")


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0, 2.0], ["x", "é"])], "item_id string, embedding array<float>, l array<string>")
    writers.write_vectors(df, str(tmp_path / "v"))
    assert rows(readers.read_vectors(spark, str(tmp_path / "v"))) == rows(df)
    writers.write_json(df, str(tmp_path / "j"))
    back = spark.read.json(str(tmp_path / "j")).select("item_id", "l")
    assert rows(back) == [("a", ["x", "é"])]
    assert rows(writers.unmatched_keys(df, df)) == []
    other = df.withColumn("item_id", F.lit("b"))
    assert rows(writers.unmatched_keys(df, other)) == [("items", 1), ("vectors", 1)]

