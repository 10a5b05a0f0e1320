from __future__ import annotations

from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from catalith.operators import language, views
from catalith.plans.prepare import prepare

# Heading lists of the sample catalogue.
HEADINGS = ["introduction", "summary", "conclusion", "annex", "appendix", "table of contents"]
HEADINGS_BY_LANGUAGE = {
    "fr": ["introduction", "résumé", "conclusion", "annexe", "appendice", "sommaire"],
    "en": [
        "introduction", "summary", "conclusion", "annex", "appendix", "table of contents",
        "overview", "background",
    ],
}

SCOPE_MASTER = (
    "north,bridges,b7,Cracked bearing plate,14\n"
    "north,bridges,b2,Loose railing bolt,3\n"
    "south,tunnels,t1,Wet cable duct,6\n"
)
SCOPE_CHAPTERS = (
    "north,bridges,b7,2,Measured width,inspector\n"
    "north,bridges,b7,1,Introduction,inspector\n"
    "north,bridges,b2,1,Where it is,foreman\n"
    "south,tunnels,t1,1,Source of the water,foreman\n"
)


def test_one_scope_end_to_end(spark, load, tmp_path):
    master, chapters = load(SCOPE_MASTER, SCOPE_CHAPTERS)
    out = str(tmp_path / "out")
    counts = {name: Observation(name) for name in ("master_in", "master_out", "chapters_in", "chapters_out")}
    found = prepare(master, chapters, "north", generic=HEADINGS, out=out, counts=counts)
    assert rows(found) == [
        ("b2", "bridges", "Loose railing bolt", "Where it is", "3 | foreman"),
        ("b7", "bridges", "Cracked bearing plate", "Measured width", "14 | inspector"),
    ]
    assert {name: seen.get["n"] for name, seen in counts.items()} == {
        "master_in": 3, "master_out": 2, "chapters_in": 4, "chapters_out": 3,
    }
    clean = spark.read.parquet(f"{out}/master")
    assert "scope" not in clean.columns and clean.count() == 2
    assert spark.read.parquet(f"{out}/chapters").count() == 3


def profiles(spark):
    samples = [
        ("en", "the hydraulic pump failure and the description of the pressure drop in the system"),
        ("en", "failure description of the engine with symptoms and issue report for the crew"),
        ("fr", "la panne du système hydraulique et la description de la panne de pression"),
        ("fr", "les symptômes de la défaillance du moteur avec le rapport pour les équipages"),
    ]
    return language.train_profiles(spark.createDataFrame(samples, "lang string, text string"))


def test_two_languages(spark, load):
    master, chapters = load(
        "north,bridges,b1,Pump of the lock and its system,9\n"
        "north,bridges,b9,La pression de la pompe du moteur,4\n",
        "north,bridges,b1,1,Overview,inspector\n"
        "north,bridges,b1,2,Report for the crew,inspector\n"
        "north,bridges,b9,1,Sommaire,foreman\n"
        "north,bridges,b9,2,Le rapport pour les équipages,foreman\n",
    )
    found = prepare(
        master, chapters, "north", generic=HEADINGS_BY_LANGUAGE, profiles=profiles(spark)
    )
    names = ["item_id", "chap_titles_text", "lang_title", "lang_chapters", "lang_item"]
    assert rows(found, *names) == [
        ("b1", "Report for the crew", "en", "en", "en"),
        ("b9", "Le rapport pour les équipages", "fr", "fr", "fr"),
    ]


def test_language_is_null_when_blank_or_tied(spark):
    model = spark.createDataFrame(
        [("en", "", 0, -3.0), ("fr", "", 0, -3.0), ("en", "_th", 2, -1.0)],
        "lang string, gram string, n bigint, log_prob double",
    )
    df = spark.createDataFrame([(1, "th"), (2, "xyz"), (3, " 12 "), (4, None)], "item_id int, t string")
    found = language.detect_languages(df, model, {"t": "lang"})
    assert rows(found, "item_id", "lang") == [(1, "en"), (2, None), (3, None), (4, None)]


def test_large_profiles_take_the_other_join(spark, monkeypatch):
    df = spark.createDataFrame(
        [(1, "the pump failure"), (2, "la panne du système"), (3, "zzz the")], "item_id int, t string"
    )
    model = profiles(spark)
    want = rows(language.detect_languages(df, model, {"t": "lang"}))
    monkeypatch.setattr(language, "BROADCAST_BYTES", 0)
    monkeypatch.setattr("catalith.operators.lookup.HOT_ROWS", 5)
    assert rows(language.detect_languages(df, model, {"t": "lang"})) == want


def test_majority_code(spark):
    df = spark.createDataFrame(
        [("en", "fr", "fr"), ("en", "fr", None), (None, "fr", None), (None, None, None), ("", "de", "")],
        "a string, b string, c string",
    ).coalesce(1)
    found = df.select(language.majority_code(*map(F.col, "abc"))).collect()
    assert [r[0] for r in found] == ["fr", "en", "fr", None, "de"]


def chapter_table(spark, data):
    return spark.createDataFrame(
        data, "item_id string, chapter_number int, chapter_title string, attestation string"
    )


def test_chapters_keep_their_order_across_runs(spark):
    numbers = [*range(200, 0, -1), 64, 64]
    data = [("a", n, f"t{n:03}", None) for n in numbers] + [("a", None, "last", None)]
    found = views.chapter_titles(chapter_table(spark, data).repartition(7))
    want = [f"t{n:03}" for n in sorted(numbers)] + ["last"]
    assert rows(found) == [("a", " || ".join(want))]


def test_one_hot_item_is_whole(spark):
    data = [("hot", n % 500 + 1, f"title {n % 500}", f"v{n % 3}") for n in range(3000)]
    data += [(f"i{n}", 1, "only", None) for n in range(300)]
    found = dict(rows(views.chapter_titles(chapter_table(spark, data))))
    assert found["hot"] == " || ".join(f"title {n}" for n in range(500) for _ in range(6))
    assert len(found) == 301


def test_metadata_of_both_tables(spark):
    master = spark.createDataFrame([("a", 8, " m "), ("b", None, "")], "item_id string, workload int, note string")
    chapters = chapter_table(spark, [("a", 1, "x", "Q"), ("a", 2, "y", "P"), ("a", 3, "z", "Q"), ("c", 1, "x", None)])
    chapters = chapters.withColumn("note", F.lit("n"))
    found = views.item_meta(master, chapters, ["workload", "note", "attestation", "absent"])
    assert rows(found) == [("a", "8 | m | n | P | Q"), ("b", ""), ("c", "n")]
    assert rows(views.item_meta(master, chapters, ["workload"])) == [("a", "8"), ("b", "")]
    no_meta = views.build_views(
        master.withColumns({"group_id": F.lit("g"), "title": F.lit("t")}), chapters, [], ["x"]
    )
    assert rows(no_meta, "item_id", "meta_text") == [("a", ""), ("b", "")]


def test_item_without_chapters(spark, load):
    master, chapters = load(
        "x,roads,r5,Sunken manhole,11\nx,roads,r6,Faded line,1\n",
        "x,roads,r5,1,Background,clerk\nx,roads,r6,1,Paint used,painter\n",
    )
    found = views.build_views(master, chapters, generic=HEADINGS_BY_LANGUAGE)
    assert rows(found, "item_id", "chap_titles_text", "meta_text") == [
        ("r5", "", "11 | clerk"),
        ("r6", "Paint used", "1 | painter"),
    ]
