from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalith.functions import text, vectors
from catalith.operators import encode

ODD = text.WHITESPACE + "\u00e9e\u0301\u00f1\u00df\ufb01\u00b2ab-_1Z"
TEXTS = st.lists(st.text(alphabet=st.sampled_from(ODD), max_size=30), min_size=1, max_size=20)
RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


@RELAXED
@given(TEXTS)
def test_normalize_text_matches_python(spark, texts):
    want = [
        re.sub(r"\s+", " ", unicodedata.normalize("NFC", t).replace("\u00a0", " ")).strip()
        for t in texts
    ]
    assert column(spark, texts, text.normalize_text) == want


@RELAXED
@given(TEXTS)
def test_strip_and_accents_match_python(spark, texts):
    assert column(spark, texts, text.strip) == [t.strip() for t in texts]
    plain = [
        "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        for t in texts
    ]
    assert column(spark, texts, text.strip_accents) == plain


def test_whitespace_set_is_what_python_strips():
    python = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(text.WHITESPACE) == python


def test_null_becomes_empty(spark):
    assert column(spark, [None], text.normalize_text) == [""]
    assert column(spark, [None], text.tokenize) == [[]]
    assert column(spark, [None], text.letter_trigrams) == [[]]


def test_generic_headings(spark):
    pool = text.generic_pool({"fr": [" Résumé ", None], "en": ["Introduction"], "de": None})
    assert pool == ["introduction", "résumé"]
    assert text.generic_pool(None) == [] and text.generic_pool(["A", "a "]) == ["a"]
    texts = ["Introduction", " RÉSUMÉ\t", "x", "", "Failure"]
    found = column(spark, texts, lambda c: text.is_generic_heading(c, pool))
    assert found == [True, True, True, True, False]


def python_text(title, chapters, meta, weights, prefix):
    def rep(value, weight):
        return (" " + value) * max(1, round(weight)) if value else ""

    parts = zip(("title:", "chapters:", "meta:"), (title, chapters, meta), weights)
    return prefix + " \n".join(label + rep(v.strip(), w) for label, v, w in parts)


def test_embedding_text_matches_python(spark):
    data = [("T", "a || b", "8 | QA"), ("  T ", "", " "), ("", "", "")]
    df = spark.createDataFrame(data, "t string, c string, m string").coalesce(1)
    for weights in ((2.0, 1.0, 0.5), (0.0, 1.5, 2.5), (3.5, 0.4, 4.5)):
        got = df.select(text.embedding_text(*map(F.col, "tcm"), *weights)).collect()
        assert [r[0] for r in got] == [python_text(*row, weights, "passage: ") for row in data]
    dropped = text.embedding_text(*map(F.col, "tcm"), 2.0, 1.0, 0.0, "", min_repeat=0)
    assert df.select(dropped).head()[0] == "title: T T \nchapters: a || b \nmeta:"


def test_tokens_and_ngrams(spark):
    texts = ["Été-2 a bc_d; x", "one", ""]
    tokens = column(spark, texts, text.tokenize)
    assert tokens == [["ete-2", "bc_d"], ["one"], []]
    grams = column(spark, texts, lambda c: text.ngrams(text.tokenize(c), 3))
    assert grams == [["ete-2", "bc_d", "ete-2 bc_d"], ["one"], []]
    assert column(spark, ["a1 b2 c3"], lambda c: text.ngrams(text.tokenize(c), 3)) == [
        ["a1", "b2", "c3", "a1 b2", "b2 c3", "a1 b2 c3"]
    ]


def test_trigrams_overlap_and_skip_non_letters(spark):
    found = column(spark, ["The  cat!", "1 2", "a", "\U0001d49cb"], text.letter_trigrams)
    assert found == [["_th", "the", "he_", "e_c", "_ca", "cat", "at_"], [], ["_a_"], ["_𝒜b", "𝒜b_"]]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 4.0])], "a array<float>, b array<float>")
    got = df.select(
        vectors.dot(F.col("a"), F.col("b")),
        vectors.l2_norm(F.col("a")),
        vectors.euclidean(F.col("a"), F.col("b")),
        vectors.distance_to_score(F.lit(0.25), "cosine"),
        vectors.distance_to_score(F.lit(0.25), "l2"),
        vectors.normalize(F.col("a")),
        text.json_list(F.array(F.lit("é"), F.lit("b"))),
    ).head()
    assert got[:5] == (16.0, 5.0, 3.0, 0.75, -0.25)
    assert [round(x, 9) for x in got[5]] == [0.6, 0.8]
    assert got[6] == '["é","b"]'
    assert rows(df.select(vectors.threshold_label(F.lit(0.35), F.lit(3), 0.35))) == [(3,)]
    assert rows(df.select(vectors.threshold_label(F.lit(0.34), F.lit(3), 0.35))) == [(-1,)]


def test_long_texts_are_changed_in_pieces(monkeypatch):
    """Pieces hold some bytes, whatever the rows of a batch; nulls and slices keep their places."""
    seen = []

    def change(value):
        seen.append(value)
        return value.upper()

    monkeypatch.setattr(text, "PIECE_BYTES", 5)
    texts = pa.array(["out", "ab", None, "c" * 20, "", None, "é", "z"])
    assert text._changed(texts.slice(1), change).to_pylist() == ["AB", None, "C" * 20, "", None, "É", "Z"]
    assert seen == ["ab", "c" * 20, "", "é", "z"]
    assert text._changed(texts.slice(0, 0), change).to_pylist() == []


def test_encoders_get_few_texts_at_a_time(spark, monkeypatch):
    """A batch of long texts is never held as Python strings in one piece."""
    held = []

    class Lengths:
        def encode(self, texts):
            assert all(type(t) is str for t in texts)
            held.append(sum(len(t.encode()) for t in texts))
            return [[len(t), 1.0] for t in texts]

    monkeypatch.setattr(text, "PIECE_BYTES", 100)
    texts = ["é" * 20, "", "b" * 250, *["c" * 30] * 7]
    found = encode._encoded(pa.array(["x", *texts]).slice(1), Lengths(), 4, False)
    assert found.to_pylist() == [[len(t), 1.0] for t in texts]
    assert len(held) == 5 and sorted(held)[-2] <= 100 and max(held) == 250
    assert encode._encoded(pa.array([], pa.string()), Lengths(), 4, True).to_pylist() == []
    rows_ = spark.createDataFrame([(i, t or None) for i, t in enumerate(texts)], "i int, text string")
    vectors = [r["embedding"] for r in encode.encode(rows_, Lengths, batch_size=3, normalize=False).orderBy("i").collect()]
    assert vectors == [[len(t), 1.0] for t in texts]

    class Short:
        def encode(self, texts):
            return [[1.0]] * (len(texts) - 1)

    with pytest.raises(ValueError, match="vectors for"):
        encode._encoded(pa.array(["a", "b"]), Short(), 64, True)


def test_encoders_run_after_texts_were_normalised(spark):
    """What tasks of an encoder are sent holds no function that Spark has already taken."""

    class Sizes:
        def encode(self, texts):
            return [[len(t)] for t in texts]

    rows_ = spark.createDataFrame([("e\u0301",), ("ab",)], "text string")
    assert rows(rows_.select(text.nfc(F.col("text")))) == [("ab",), ("é",)]
    found = encode.encode(rows_, Sizes, normalize=False)
    assert rows(found.select("embedding")) == [([2.0],), ([2.0],)]
