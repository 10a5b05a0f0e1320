"""Text expressions: normalisation, headings, weighted text, tokens, n-grams."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every code point that counts as whitespace.
WHITESPACE = (
    " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: a token is two or more word characters or inner hyphens.
TOKEN = r"[\p{L}\p{N}_][\p{L}\p{N}_\-]*[\p{L}\p{N}_]"

MIN_HEADING_LENGTH = 2


# Bytes of text that a task holds as Python strings at a time.
PIECE_BYTES = 1 << 20


def piece_stop(ends: np.ndarray, start: int, begin: int) -> int:
    """Where a piece of some bytes, or of one text, stops that begins with text ``start`` at byte ``begin``."""
    return max(start + 1, int(np.searchsorted(ends, begin + PIECE_BYTES, side="right")))


def _changed(texts: pa.Array, change) -> pa.Array:
    """``change`` of each text, some at a time, so that a batch of long texts takes its bytes only."""
    # Batches that are a slice of a longer array count from their own start.
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    found, start, begin = [], 0, 0
    while start < len(texts):
        stop = piece_stop(ends, start, begin)
        part = texts.slice(start, stop - start)
        found.append(part if part.null_count == len(part) else pa.array(
            [None if t is None else change(t) for t in part.to_pylist()], pa.string()
        ))
        start, begin = stop, ends[stop - 1]
    return pa.concat_arrays([f.cast(pa.string()) for f in found]) if found else pa.array([], pa.string())


@F.arrow_udf(T.StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    return _changed(texts, lambda t: unicodedata.normalize("NFC", t))


@F.arrow_udf(T.StringType())
def _without_marks(texts: pa.Array) -> pa.Array:
    def strip(value: str) -> str:
        parts = unicodedata.normalize("NFKD", value)
        return "".join(c for c in parts if not unicodedata.combining(c))

    return _changed(texts, strip)


def nfc(col: Column) -> Column:
    """Unicode NFC. Text below U+0300 is in NFC already and stays in the JVM."""
    changed = _nfc(F.when(col.rlike(r"[^\x{0}-\x{2ff}]"), col))
    return F.coalesce(changed, col)


def strip_accents(col: Column) -> Column:
    """NFKD without combining marks. ASCII text stays in the JVM."""
    changed = _without_marks(F.when(col.rlike(r"[^\x{0}-\x{7f}]"), col))
    return F.coalesce(changed, col)


def strip(col: Column) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def collapse_whitespace(col: Column) -> Column:
    """One blank for each run of whitespace, none at the ends."""
    blanks = F.translate(col, WHITESPACE, " " * len(WHITESPACE))
    return F.btrim(F.regexp_replace(blanks, " {2,}", " "))


def normalize_text(col: Column) -> Column:
    """Null to empty, NFC, one blank for each run of whitespace, stripped."""
    return collapse_whitespace(nfc(F.coalesce(col.cast("string"), F.lit(""))))


def generic_pool(headings: Iterable[str] | Mapping[str, Iterable[str]] | None) -> list[str]:
    """Flat, lower-cased, distinct headings from a list or a per-language dict."""
    if isinstance(headings, Mapping):
        found = [h for values in headings.values() for h in (values or [])]
    else:
        found = list(headings or [])
    return sorted({str(h).lower().strip() for h in found if h})


def is_generic_heading(col: Column, pool: list[str]) -> Column:
    """Listed in ``pool``, or too short to carry meaning."""
    heading = F.lower(strip(col))
    short = F.length(heading) < MIN_HEADING_LENGTH
    return (heading.isin(pool) | short) if pool else short


def repeat_count(weight: float, min_repeat: int = 1) -> int:
    """How often a field of this weight is repeated (halves round to even)."""
    return max(min_repeat, round(weight))


# What the fields of a weighted text start with.
LABELS = ("title:", "chapters:", "meta:")


def embedding_text(
    title: Column,
    chapters: Column,
    meta: Column,
    w_title: float = 2.0,
    w_chaps: float = 1.0,
    w_meta: float = 0.5,
    prefix: str = "passage: ",
    min_repeat: int = 1,
    labels: tuple[str, str, str] = LABELS,
) -> Column:
    """One labelled text per item in which a field is repeated by its weight.

    A weight never removes a field unless ``min_repeat`` is 0.
    """

    def field(label: str, col: Column, weight: float) -> Column:
        text = strip(F.coalesce(col, F.lit("")))
        copies = F.repeat(F.concat(F.lit(" "), text), F.lit(repeat_count(weight, min_repeat)))
        return F.concat(F.lit(label), F.when(text == "", "").otherwise(copies))

    body = F.concat_ws(
        " \n",
        field(labels[0], title, w_title),
        field(labels[1], chapters, w_chaps),
        field(labels[2], meta, w_meta),
    )
    return F.concat(F.lit(prefix or ""), body)


def report_text(title: Column, chapters: Column, meta: Column) -> Column:
    """Lower-cased text of an item for the term report."""
    parts = [F.coalesce(c, F.lit("")) for c in (title, chapters, meta)]
    return F.lower(F.concat_ws(" \n ", *parts))


def tokenize(col: Column, accents: bool = False) -> Column:
    """Lower-cased tokens in order; accents are stripped unless ``accents``."""
    text = F.lower(F.coalesce(col, F.lit("")))
    return F.regexp_extract_all(text if accents else strip_accents(text), F.lit(TOKEN), F.lit(0))


def ngrams(tokens: Column, n_max: int = 2) -> Column:
    """All runs of 1 to ``n_max`` adjacent tokens, each joined with a blank."""
    grams = tokens
    for n in range(2, n_max + 1):
        count = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
        run = F.slice(tokens, F.lit(1), count)
        for offset in range(1, n):
            run = F.zip_with(
                run,
                F.slice(tokens, F.lit(offset + 1), count),
                lambda a, b: F.concat_ws(" ", a, b),
            )
        grams = F.concat(grams, run)
    return grams


def letters(col: Column) -> Column:
    """The lower-cased letters between ``_``, which stands for anything else and for both ends."""
    found = F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}]+", "_")
    return F.concat(F.lit("_"), F.btrim(found, F.lit("_")), F.lit("_"))


def letter_trigrams(col: Column) -> Column:
    """Every overlapping run of three characters of :func:`letters`, which also marks word borders."""
    # The look-ahead makes matches overlap; each match takes one code point, so the scan is linear.
    return F.regexp_extract_all(letters(col), F.lit("(?=(...))."), F.lit(1))


def json_list(col: Column) -> Column:
    """JSON text of a list column, non-ASCII characters kept."""
    return F.to_json(col)
