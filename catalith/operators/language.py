"""Language of short texts from letter-trigram profiles.

A profile table that fits the broadcast limit becomes a sorted array of trigrams and a
matrix of log-probabilities, one column per language. Texts are scored where they are,
as Arrow batches: their trigrams are numbers, found in the sorted array, and summed per
text. Nothing is exploded, shuffled or written, and other columns stay in the JVM.
Larger tables are joined.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..session import BROADCAST_BYTES, materialize
from .lookup import lookup
from .pairwise import numbered

# Languages whose totals are broadcast.
BROADCAST_LANGUAGES = 10_000
_ROW = "language_row"
# The profile row for trigrams that a language never showed.
UNSEEN = ""
# Scores are compared after rounding to this many digits.
SCORE_DIGITS = 6
# Characters whose trigrams are held at a time.
_CHARACTERS = 2_000_000
# A code point has 21 bits.
_BITS = 21


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that have at most ``_CHARACTERS`` together, or are one text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > _CHARACTERS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def gram_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of the texts as numbers, and the text each comes from."""
    # No text holds the character between them, as all but letters and "_" is gone.
    codes = np.frombuffer("\0".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    if len(codes) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    between = codes == 0
    inside = ~(between[:-2] | between[1:-1] | between[2:])
    grams = (codes[:-2] << 2 * _BITS) | (codes[1:-1] << _BITS) | codes[2:]
    return grams[inside], np.cumsum(between)[:-2][inside]


def gram_texts(grams: np.ndarray) -> list[str]:
    """The trigrams of numbers."""
    mask = (1 << _BITS) - 1
    codes = np.stack([grams >> 2 * _BITS, (grams >> _BITS) & mask, grams & mask], axis=1)
    joined = codes.astype("<u4").tobytes().decode("utf-32-le")
    return [joined[i : i + 3] for i in range(0, len(joined), 3)]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, gram, n)`` of the texts of a task, some texts of a language at a time."""
    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            texts = batch.column("letters").filter(pc.equal(langs, lang)).to_pylist()
            for start, stop in _pieces(texts):
                grams, n = np.unique(gram_numbers(texts[start:stop])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(gram_texts(grams), pa.string()), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"],
                )


def train_profiles(
    labelled: DataFrame, text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """``(lang, gram, n, log_prob)`` from labelled texts, Laplace smoothed.

    The row with the empty gram holds the probability of unseen trigrams.
    """
    rows = labelled.where(F.col(lang_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"), text.letters(F.col(text_column)).alias("letters")
    )
    grams = rows.mapInArrow(_count_grams, "lang string, gram string, n long")
    counts = materialize(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    vocabulary = counts.select("gram").distinct().count()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    few = totals.count() <= BROADCAST_LANGUAGES

    def log_prob(n: Column) -> Column:
        return F.log((n + F.lit(1.0)) / (F.col("total") + F.lit(vocabulary)))

    known = counts.join(F.broadcast(totals) if few else totals, "lang").select(
        "lang", "gram", "n", log_prob(F.col("n")).alias("log_prob")
    )
    unseen = totals.select(
        "lang", F.lit(UNSEEN).alias("gram"), F.lit(0).cast("bigint").alias("n"),
        log_prob(F.lit(0)).alias("log_prob"),
    )
    return known.unionByName(unseen)


def _wide(profiles: DataFrame, floors: dict[str, float]) -> DataFrame:
    """One row per trigram with a log-probability per language and its count."""
    columns = [
        F.coalesce(F.max(F.when(F.col("lang") == lang, F.col("log_prob"))), F.lit(floor)).alias(f"p{i}")
        for i, (lang, floor) in enumerate(floors.items())
    ]
    seen = profiles.where(F.col("gram") != UNSEEN)
    return seen.groupBy("gram").agg(*columns, F.sum("n").alias("seen"))


def language_scores(
    df: DataFrame, profiles: DataFrame, fields: list[str], id_column: str = "item_id"
) -> DataFrame:
    """``(id, field, lang, score)`` of every language for texts with letters."""
    floor_rows = profiles.where(F.col("gram") == UNSEEN).orderBy("lang").collect()
    floors = {row["lang"]: row["log_prob"] for row in floor_rows}
    texts = F.array(
        *[
            F.struct(F.lit(f).alias("field"), text.letter_trigrams(F.col(f)).alias("grams"))
            for f in fields
        ]
    )
    grams = df.select(id_column, F.explode(texts).alias("t")).select(
        id_column, "t.field", F.explode("t.grams").alias("gram")
    )
    table = _wide(profiles, floors)
    # One row per trigram with a number per language, whatever the languages share.
    cells = profiles.select("gram").distinct().count() * (len(floors) + 4)
    if cells * 8 <= BROADCAST_BYTES:
        found = grams.join(F.broadcast(table), "gram", "left")
    else:
        found = lookup(grams, table, "gram", "seen", "left")
    # Rows are summed per text before the shuffle.
    sums = found.groupBy(id_column, "field").agg(
        *[
            F.sum(F.coalesce(F.col(f"p{i}"), F.lit(floor))).alias(f"s{i}")
            for i, floor in enumerate(floors.values())
        ]
    )
    scores = F.array(
        *[
            F.struct(F.lit(lang).alias("lang"), F.col(f"s{i}").alias("score"))
            for i, lang in enumerate(floors)
        ]
    )
    return sums.select(id_column, "field", scores.alias("scores"))


@dataclass(frozen=True)
class GramTable:
    """Sorted trigrams and their log-probabilities; the last row is for all others."""

    langs: list[str]
    grams: np.ndarray
    log_probs: np.ndarray

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sums per text and language, and the number of trigrams of each text."""
        sums, counts = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=np.int64)
        for start, stop in _pieces(texts):
            grams, rows = gram_numbers(texts[start:stop])
            n = stop - start
            counts[start:stop] = np.bincount(rows, minlength=n)
            at = np.minimum(np.searchsorted(self.grams, grams), max(0, len(self.grams) - 1))
            known = self.grams[at] == grams if len(self.grams) else np.zeros(len(grams), dtype=bool)
            at = np.where(known, at, len(self.grams))
            for j in range(len(self.langs)):
                sums[start:stop, j] = np.bincount(rows, weights=self.log_probs[at, j], minlength=n)
        return sums, counts

    def best(self, texts: list[str]) -> list[str | None]:
        """The single best language of each text; null without letters and for a tie."""
        if not self.langs:
            return [None] * len(texts)
        sums, counts = self.scores(texts)
        sums = np.round(sums, SCORE_DIGITS)
        top = sums.max(axis=1)
        single = ((sums == top[:, None]).sum(axis=1) == 1) & (counts > 0)
        return [self.langs[j] if one else None for j, one in zip(sums.argmax(axis=1), single, strict=True)]


def gram_table(profiles: DataFrame, limit: int | None = None) -> GramTable | None:
    """The profiles as arrays, or None if they exceed the broadcast limit."""
    limit = BROADCAST_BYTES if limit is None else limit
    size = profiles.agg(F.count_distinct("gram").alias("grams"), F.count_distinct("lang").alias("langs")).first()
    if 8 * (size["grams"] + 1) * (size["langs"] + 1) > limit:
        return None
    # At most one row per cell of the matrix that has just been measured.
    table = profiles.select("lang", "gram", "log_prob").toPandas()
    unseen = table[table["gram"] == UNSEEN].set_index("lang")["log_prob"]
    langs = sorted(unseen.index)
    seen = table[table["gram"] != UNSEEN]
    codes = np.frombuffer("".join(seen["gram"]).encode("utf-32-le"), dtype=np.uint32).astype(np.int64).reshape(-1, 3)
    numbers = (codes[:, 0] << 2 * _BITS) | (codes[:, 1] << _BITS) | codes[:, 2]
    grams, row = np.unique(numbers, return_inverse=True)
    log_probs = np.tile(unseen[langs].to_numpy(dtype=float), (len(grams) + 1, 1))
    log_probs[row, np.searchsorted(langs, seen["lang"].to_numpy(dtype=object))] = seen["log_prob"]
    return GramTable(langs, grams, log_probs)


def _winner(scores: Column) -> Column:
    """The single best language; null when two languages tie."""
    best = F.array_max(F.transform(scores, lambda s: F.round(s["score"], SCORE_DIGITS)))
    winners = F.filter(scores, lambda s: F.round(s["score"], SCORE_DIGITS) == best)
    return F.when(F.size(winners) == 1, F.element_at(winners, 1)["lang"])


def _detect_by_join(df: DataFrame, profiles: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """For profiles that no task can hold: trigrams as rows, joined with the profiles."""
    # Rows are told apart by a number of their own, as ids may repeat or be null.
    df = numbered(df, _ROW)
    scores = language_scores(df, profiles, list(fields), _ROW)
    langs = scores.withColumn("lang", _winner(F.col("scores")))
    per_item = langs.groupBy(_ROW).agg(
        *[
            F.max(F.when(F.col("field") == field, F.col("lang"))).alias(name)
            for field, name in fields.items()
        ]
    )
    return df.join(per_item, _ROW, "left").drop(_ROW)


def detect_languages(
    df: DataFrame,
    profiles: DataFrame,
    fields: Mapping[str, str],
) -> DataFrame:
    """``df`` with a language column for each text: ``fields`` maps text to name.

    A text without letters, or undecided between languages, gets null. Each row
    has its own languages, also if its id repeats. Only the texts leave the JVM.
    """
    table = gram_table(profiles)
    if table is None:
        return _detect_by_join(df, profiles, fields)
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("string")
    def best(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.best(texts.to_pylist()), pa.string())

    return df.withColumns({name: best(text.letters(F.col(field))) for field, name in fields.items()})


def majority_code(*codes: Column) -> Column:
    """The most frequent non-null code; ties go to the earlier argument."""
    present = F.filter(F.array(*codes), lambda c: c.isNotNull() & (c != ""))
    ranked = F.transform(
        present,
        lambda c: F.struct(
            F.size(F.filter(present, lambda other: other == c)).alias("n"),
            (-F.array_position(present, c)).alias("before"),
            c.alias("code"),
        ),
    )
    return F.array_max(ranked)["code"]


def item_language(views: DataFrame, profiles: DataFrame) -> DataFrame:
    """``views`` with ``lang_title``, ``lang_chapters`` and ``lang_item``."""
    names = {"title_text": "lang_title", "chap_titles_text": "lang_chapters"}
    found = detect_languages(views, profiles, names)
    return found.withColumn("lang_item", majority_code(*map(F.col, names.values())))
