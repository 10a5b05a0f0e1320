"""Secrets in whole texts: known forms, and segments of high sliding-window entropy.

Four kinds of spans, all in code points with an exclusive end:

* ``assign``, ``access``, ``hex``: the leftmost non-overlapping matches of a
  pattern, of which those that are too short are dropped.
* ``entropy``: a segment of a run of one character class in which some window of
  ``width`` characters has at least ``bits`` of Shannon entropy. The window moves by
  one character at a time; the counts of the leaving and of the entering character
  change by one, and the sum of ``c log2 c`` follows from these two counts.

The allow-list blanks what it matches inside a run (words of examples, UUIDs, and
parts between separators that are letters only or digits only, as in paths, slugs
and dates). What remains between the blanks, without separators at its ends, are
the segments, so a key behind a path is found and told apart from the path.
Segments inside a span of another kind are suppressed.

Everything is a column expression, so no row leaves the JVM and nothing is
shuffled. No pattern repeats a group, since such patterns are matched by recursion,
and a segment is cut once into pieces of ``PIECE`` windows that overlap by
``width - 1`` characters, so the work is linear in the text whatever its runs are.

Defined cases: a null text reads as empty and has no spans. Rows that repeat are
scanned each for itself. Only the text column is read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base forms, in the order in which they are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs of one class are maximal, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_CHARS = 12
KINDS = ("assign", "access", "hex", "entropy")

# Text that looks random and is no secret; a match is blanked.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    *("(?i)" + word for word in ("example", "sample", "placeholder", "dummy", "changeme", "xxxxxxxx", "00000000", "12345678")),
)
ALLOWED_SIZES = (36, 7, 6, 11, 5, 8, 8, 8, 8)
BLANK = " "
SEGMENT = r"[A-Za-z0-9][^ ]*[A-Za-z0-9]"
PIECE = 256


@dataclass(frozen=True)
class RandomRun:
    """Runs of ``alphabet`` of at least ``width`` characters that reach ``bits``."""

    pattern: str
    alphabet: str
    width: int
    bits: float
    fold: bool = False


# The classes, with window and threshold.
RUNS = (
    RandomRun(r"[A-Za-z0-9+/_-]{20,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 20, 3.8),
    RandomRun(r"[0-9A-F]{20,}", "0123456789abcdef", 16, 3.0, fold=True),
)

PAIR = "struct<start:int,end:int>"
SPAN = "struct<start:int,rank:int,end:int>"
CHUNK = 64


def _places(text: Column, pattern: str, group: int = 0) -> Column:
    """``(gap, found, part)`` of each match: what lies before it, it, its group."""
    return F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )


def _positions(places: Column) -> Column:
    """Start and end of each match, from the lengths of all that comes before.

    Matches are added up in chunks and the chunks among themselves, so the work
    does not grow with the square of their number.
    """

    def local(chunk: Column) -> Column:
        begun = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{PAIR}>").alias("out"))

        def step(state: Column, x: Column) -> Column:
            start = state["at"] + F.length(x["gap"])
            end = start + F.length(x["found"])
            return F.struct(
                end.alias("at"),
                F.array_append(state["out"], F.struct(start.alias("start"), end.alias("end"))).alias("out"),
            )

        return F.aggregate(chunk, begun, step)

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(places) - 1) / CHUNK).cast("int")),
        lambda i: local(F.slice(places, i * CHUNK + 1, CHUNK)),
    )
    begun = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{PAIR}>>").alias("out"))

    def join(state: Column, x: Column) -> Column:
        moved = F.transform(
            x["out"],
            lambda p: F.struct((p["start"] + state["at"]).alias("start"), (p["end"] + state["at"]).alias("end")),
        )
        return F.struct(
            (state["at"] + x["at"]).alias("at"), F.array_append(state["out"], moved).alias("out")
        )

    return F.flatten(F.aggregate(chunks, begun, join)["out"])


def blanked(run: Column) -> Column:
    """``run`` with as many blanks in place of what the allow-list matches."""
    for pattern, size in zip(ALLOWED, ALLOWED_SIZES, strict=True):
        run = F.regexp_replace(run, pattern, BLANK * size)
    parts = F.regexp_extract_all(run, F.lit("[A-Za-z0-9]+|[^A-Za-z0-9]+"), F.lit(0))
    plain = F.transform(
        parts, lambda p: F.when(p.rlike("^(?:[A-Za-z]+|[0-9]+)$"), F.repeat(F.lit(BLANK), F.length(p))).otherwise(p)
    )
    return F.array_join(plain, "")


def reaches(segment: Column, run: RandomRun) -> Column:
    """Whether some window of ``segment`` has the entropy of ``run``; stops at the first piece that has one."""
    # The look-ahead takes the windows that begin in a piece, the match itself goes on by the piece.
    cut = rf"(?=(.{{1,{PIECE + run.width - 1}}})).{{1,{PIECE}}}"
    return F.exists(F.regexp_extract_all(segment, F.lit(cut), F.lit(1)), lambda piece: _piece_reaches(piece, run))


def _piece_reaches(piece: Column, run: RandomRun) -> Column:
    letters = F.regexp_extract_all(piece, F.lit("."), F.lit(0))
    codes = F.transform(letters, lambda c: F.instr(F.lit(run.alphabet), c))
    first = F.substring(piece, 1, run.width)
    counts = F.transform(
        F.array(*map(F.lit, run.alphabet)), lambda a: F.length(first) - F.length(F.replace(first, a, F.lit("")))
    )
    terms = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(run.width + 2)))

    def term(count: Column) -> Column:
        return F.element_at(terms, count + 1)

    def high(total: Column) -> Column:
        return F.round(F.lit(math.log2(run.width)) - total / run.width, 9) >= run.bits

    def changed(counts: Column, code: Column, by: int) -> Column:
        return F.concat(
            F.slice(counts, F.lit(1), code - 1),
            F.array(F.element_at(counts, code) + by),
            F.slice(counts, code + 1, F.lit(len(run.alphabet))),
        )

    def scan(named: Column) -> Column:
        codes = named["codes"]
        total = F.aggregate(named["counts"], F.lit(0.0), lambda s, c: s + term(c))

        def step(state: Column, i: Column) -> Column:
            gone, come = F.element_at(codes, i), F.element_at(codes, i + run.width)
            less, more = F.element_at(state["counts"], gone), F.element_at(state["counts"], come)
            moved = state["total"] - term(less) + term(less - 1) - term(more) + term(more + 1)
            following = F.struct(
                changed(changed(state["counts"], gone, -1), come, 1).alias("counts"),
                moved.alias("total"),
                high(moved).alias("high"),
            )
            return F.when(state["high"] | (gone == come), state).otherwise(following)

        begun = F.struct(named["counts"].alias("counts"), total.alias("total"), high(total).alias("high"))
        steps = F.when(F.size(codes) > run.width, F.sequence(F.lit(1), F.size(codes) - run.width))
        return F.aggregate(F.coalesce(steps, F.array().cast("array<int>")), begun, step)["high"]

    # A transform over one element names values that are used many times.
    named = F.array(F.struct(codes.alias("codes"), counts.alias("counts")))
    varied = F.size(F.array_distinct(letters)) >= math.ceil(2**run.bits - 1e-9)
    long_enough = F.length(piece) >= run.width
    return F.when(long_enough & varied, F.element_at(F.transform(named, scan), 1)).otherwise(F.lit(False))


def _segments(places: Column, run: RandomRun) -> Column:
    """``(start, end)`` of the segments of high entropy in each run of ``(start, part)``."""

    def within(place: Column) -> Column:
        def named(found: Column) -> Column:
            zipped = F.zip_with(
                found, _positions(found), lambda x, p: F.struct(p["start"].alias("start"), p["end"].alias("end"), x["part"].alias("part"))
            )
            kept = F.filter(zipped, lambda x: F.when(F.length(x["part"]) >= run.width, reaches(x["part"], run)).otherwise(False))
            return F.transform(
                kept,
                lambda x: F.struct((place["start"] + x["start"]).alias("start"), (place["start"] + x["end"]).alias("end")),
            )

        shown = blanked(F.lower(place["part"]) if run.fold else place["part"])
        return F.element_at(F.transform(F.array(_places(shown, SEGMENT)), named), 1)

    return F.flatten(F.transform(places, within))


def _largest_so_far(values: Column) -> Column:
    """The running maximum of an array, in chunks as in ``_positions``."""

    def local(chunk: Column) -> Column:
        begun = F.struct(F.lit(-1).alias("most"), F.array().cast("array<int>").alias("out"))

        def step(state: Column, x: Column) -> Column:
            most = F.greatest(state["most"], x)
            return F.struct(most.alias("most"), F.array_append(state["out"], most).alias("out"))

        return F.aggregate(chunk, begun, step)

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
        lambda i: local(F.slice(values, i * CHUNK + 1, CHUNK)),
    )
    begun = F.struct(F.lit(-1).alias("most"), F.array().cast("array<array<int>>").alias("out"))

    def join(state: Column, x: Column) -> Column:
        raised = F.transform(x["out"], lambda v: F.greatest(v, state["most"]))
        return F.struct(
            F.greatest(state["most"], x["most"]).alias("most"), F.array_append(state["out"], raised).alias("out")
        )

    return F.flatten(F.aggregate(chunks, begun, join)["out"])


def _outside(base: Column, added: Column) -> Column:
    """Both kinds of spans by start, without the ``added`` ones that lie inside one of ``base``."""

    def sifted(both: Column) -> Column:
        ends = F.transform(both, lambda s: F.when(s["rank"] < len(KINDS) - 1, s["end"]).otherwise(-1))

        def kept(reach: Column) -> Column:
            return F.filter(
                both, lambda s, i: (s["rank"] < len(KINDS) - 1) | (F.element_at(reach, i + 1) < s["end"])
            )

        return F.element_at(F.transform(F.array(_largest_so_far(ends)), kept), 1)

    sorted_spans = F.array_sort(F.concat(base, added))
    return F.when((F.size(base) > 0) & (F.size(added) > 0), F.element_at(F.transform(F.array(sorted_spans), sifted), 1)).otherwise(
        sorted_spans
    )


def _typed(pairs: Column, rank: int) -> Column:
    return F.transform(
        pairs, lambda p: F.struct(p["start"].alias("start"), F.lit(rank).alias("rank"), p["end"].alias("end"))
    )


def _shown(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ","
    )


def find_secrets(df: DataFrame, text: str = "text", runs: tuple[RandomRun, ...] = RUNS) -> DataFrame:
    """``df`` with ``base_spans`` and ``all_spans``: ``(start, rank, end)`` by start.

    ``rank`` is the place in ``KINDS``. Columns of these two names are replaced.
    """
    nothing = F.array().cast(f"array<{SPAN}>")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = df.drop("base_spans", "all_spans")
    found = []
    for name, pattern, group, rank in (
        ("assign", ASSIGN, 2, 0),
        ("access", ACCESS, 0, 1),
        ("hex", HEX, 0, 2),
        *((f"run{i}", run.pattern, 0, 3) for i, run in enumerate(runs)),
    ):
        column = f"__{name}"
        empty = F.array().cast("array<struct<gap:string,found:string,part:string>>")
        out = out.withColumn(column, F.when(body.rlike(pattern), _places(body, pattern, group)).otherwise(empty))
        found.append((column, rank))
    for (column, rank), run in zip(found, (None, None, None, *runs), strict=True):
        places = F.col(column)
        # The last gap has no match, so its end is the end of the text.
        zipped = F.zip_with(
            places,
            _positions(places),
            lambda x, p: F.struct(p["start"].alias("start"), p["end"].alias("end"), x["part"].alias("part")),
        )
        least = ASSIGN_CHARS if column == "__assign" else 0
        kept = F.filter(zipped, lambda x: x["part"].isNotNull() & (F.length(x["part"]) >= least))
        pairs = kept if run is None else _segments(kept, run)
        out = out.withColumn(column, F.when(F.size(places) > 0, _typed(pairs, rank)).otherwise(nothing))
    base = F.array_sort(F.concat(F.col("__assign"), F.col("__access"), F.col("__hex")))
    out = out.withColumn("base_spans", base)
    added = F.array_distinct(F.concat(nothing, *(F.col(c) for c, rank in found if rank == 3)))
    out = out.withColumn("all_spans", _outside(F.col("base_spans"), added))
    return out.drop(*(c for c, _ in found))


def secret_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    found = find_secrets(df.select(F.col(key).alias("row_key"), F.col(text).alias("body")), "body")

    def count(rank: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        F.col("row_key").alias(key),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_shown(F.col("base_spans")), 256).alias("base_sha256"),
        _shown(F.col("all_spans")).alias("spans"),
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``mark``."""
    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        # A span that touches nothing before it copies the text since the last one.
        between = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    end = F.aggregate(spans, begun, step)
    rest = F.substr(text, end["at"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(end["out"], rest)).otherwise(text)


def redact_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its secrets replaced; rows without secrets, and null texts, stay as they are."""
    found = find_secrets(df, text)
    return found.withColumn(text, redact(F.col(text), F.col("all_spans"))).select(*df.columns)
