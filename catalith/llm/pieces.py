"""Encoding to vocabulary pieces by streaming Viterbi, and decoding.

The vocabulary is a list of pieces with scores, which are log-probabilities. A model
made by merges has the order of its merges instead; a piece of rank r then gets the
probability ``1 / (r + OFFSET)``, over the sum of all, by the law of Zipf and Mandelbrot,
so nothing is trained. The encoding of a text is the segmentation with the largest sum
of scores; of equal sums, the one whose last
piece is shorter, decided at each boundary. A space is written as U+2581 and one
is put before the text. A character without a piece, and U+2581 itself, is
written as its UTF-8 bytes, each of which is a piece, at the score of the worst
piece less a penalty.

``Stream`` reads characters one by one. It keeps scores for the last ``longest``
boundaries only, since no piece reaches further back, and the back pointers
since the last commit. Whenever all back pointers that can still be reached meet
at one boundary, the ids up to there are final and given out, so a text of any
length needs a bounded window.

Where no piece of the vocabulary goes on over the start of a space, every path
meets there. The parts between such boundaries then have encodings of their own,
and a task remembers those of frequent short parts.

Defined cases: a null text has null ids; an empty text has none. Ids outside the
vocabulary are an error in decoding. Rows are encoded each for itself, so
repeats are equal. The model file is read on the driver and sent to the
executors, at most ``VOCABULARY_BYTES``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Stands for a literal U+2581 of the text; no valid text holds a lone surrogate.
LITERAL = "\ud800"
PENALTY = 10.0
#: Of the law that turns ranks of merges into probabilities.
OFFSET = 2.7
#: Encodings that a task remembers, and the longest part for which it does.
REMEMBERED = 300_000
SHORT = 48
VOCABULARY_BYTES = 64 << 20
NOTHING = (-float("inf"), ())
BYTE = re.compile(r"^<0x([0-9A-F]{2})>$")


@dataclass(eq=False)
class Vocabulary:
    """Pieces and scores by id; ids of the 256 bytes; pieces that are never text."""

    pieces: list[str]
    scores: list[float]
    plain: list[bool]
    bytes_: list[int]
    ids: dict[str, int] = field(init=False)
    longest: int = field(init=False)
    unknown: float = field(init=False)
    #: For every end of a piece, ``(score, (id,))``, or ``NOTHING`` if it is no piece itself.
    ends: dict[str, tuple[float, tuple[int, ...]]] = field(init=False)
    breaks: bool = field(init=False)

    def __post_init__(self) -> None:
        if sum(len(p.encode()) for p in self.pieces) > VOCABULARY_BYTES:
            raise ValueError("the vocabulary is too large to send to every executor")
        text = [i for i, plain in enumerate(self.plain) if plain]
        if any(i >= 0 for i in self.bytes_) and min(self.bytes_) < 0:
            raise ValueError("the vocabulary has pieces for some bytes only")
        self.ids = {self.pieces[i]: i for i in text}
        self.longest = max((len(self.pieces[i]) for i in text), default=1)
        # Scores far below all others only mark pieces that another tokenizer builds from parts.
        usual = [self.scores[i] for i in text if self.scores[i] > -1e8]
        self.unknown = min(usual, default=0.0) - PENALTY
        self.ends = {self.pieces[i][n:]: NOTHING for i in text for n in range(len(self.pieces[i]))}
        self.ends.update((self.pieces[i], (self.scores[i], (i,))) for i in text)
        # Whether a space always starts a piece, unless it follows another space.
        self.breaks = not any(SPACE in self.pieces[i].lstrip(SPACE) for i in text)


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    bytes_ = [-1] * 256
    for i, piece in enumerate(pieces):
        if model.is_byte(i):
            bytes_[int(BYTE.match(piece)[1], 16)] = i
    plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    return Vocabulary(pieces, log_probabilities([model.get_score(i) for i in range(n)], plain), plain, bytes_)


def log_probabilities(scores: list[float], plain: list[bool]) -> list[float]:
    """``scores``, or, if those of the plain pieces are the ranks of merges, log-probabilities by rank."""
    usual = [s for s, p in zip(scores, plain, strict=True) if p and s > -1e8]
    if not usual or len(set(usual)) < len(usual) or any(s > 0 or s != int(s) for s in usual):
        return scores
    total = math.log(sum(1 / (OFFSET - s) for s in usual))
    return [-math.log(OFFSET - s) - total if p and s > -1e8 else s for s, p in zip(scores, plain, strict=True)]


class Stream:
    """Viterbi over characters as they come; ``push`` and ``close`` give final ids."""

    def __init__(self, vocabulary: Vocabulary, check: int = 32):
        self.v = vocabulary
        self.check = check
        self._restart("")

    def _restart(self, text: str) -> None:
        self.text = text
        # For each boundary since the last commit: score, previous boundary, ids of the piece.
        self.scores = [0.0]
        self.before = [-1]
        self.ids: list[tuple[int, ...]] = [()]

    def push(self, characters: str) -> Iterator[int]:
        """Take characters in order and give out the ids that are final."""
        for begin in range(0, len(characters), self.check):
            self.advance(characters[begin : begin + self.check])
            if len(self.text) >= self.check:
                yield from self._commit()

    def advance(self, characters: str) -> None:
        """Take characters in order without giving out ids."""
        get, single, unknown = self.v.ends.get, self.v.ids, self.v.unknown
        size = len(self.text)
        self.text += characters
        text, scores, before, ids = self.text, self.scores, self.before, self.ids
        for end in range(size + 1, len(text) + 1):
            start = end - 1
            c = text[start]
            best, back, known = NOTHING[0], -1, ()
            piece = get(c)
            while piece is not None:
                score = scores[start] + piece[0]
                if score > best:
                    best, back, known = score, start, piece[1]
                if not start:
                    break
                start -= 1
                piece = get(text[start:end])
            if c not in single:
                score = scores[end - 1] + unknown
                if back < 0 or score > best:
                    raw = (SPACE if c == LITERAL else c).encode("utf-8", "replace")
                    best, back, known = score, end - 1, tuple(self.v.bytes_[b] for b in raw)
            scores.append(best)
            before.append(back)
            ids.append(known)

    def _commit(self) -> Iterator[int]:
        """Give out what all paths share that a later piece can still build on."""
        end = len(self.text)
        alive = set(range(max(0, end - self.v.longest + 1), end + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(self.before[last])
            if 0 in alive:
                return
        meet = alive.pop()
        if meet <= 0:
            return
        yield from self._path(meet)
        # Scores count from the commit, so they do not grow with the text.
        base = self.scores[meet]
        self.text = self.text[meet:]
        self.scores = [score - base for score in self.scores[meet:]]
        self.before = [-1, *(b - meet for b in self.before[meet + 1 :])]
        self.ids = [(), *self.ids[meet + 1 :]]

    def _path(self, boundary: int) -> list[int]:
        steps = []
        while boundary > 0:
            steps.append(self.ids[boundary])
            boundary = self.before[boundary]
        return [i for ids in reversed(steps) for i in ids]

    def close(self) -> list[int]:
        ids = self._path(len(self.text))
        self._restart("")
        return ids


class Encoder:
    """Encodes and decodes texts; remembers the encodings of short parts."""

    PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.stream = Stream(vocabulary)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.raw = [p.replace(SPACE, " ").encode() if plain else b"" for p, plain in zip(vocabulary.pieces, vocabulary.plain, strict=True)]
        for value, i in enumerate(vocabulary.bytes_):
            if i >= 0:
                self.raw[i] = bytes([value])

    def _viterbi(self, part: str) -> tuple[int, ...]:
        if len(part) < self.stream.check:
            # Its end is a boundary where all paths meet, which comes before the first commit.
            self.stream.advance(part)
            return tuple(self.stream.close())
        return (*self.stream.push(part), *self.stream.close())

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        marked = SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)
        if not self.v.breaks:
            return np.array(self._viterbi(marked), dtype=np.int32)
        parts = self.PARTS.findall(marked)
        found = list(map(self.known.get, parts))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    part = parts[i]
                    found[i] = self.known.get(part) or self.older.get(part) or self._viterbi(part)
                    if len(part) <= SHORT:
                        self.known[part] = found[i]
            if len(self.known) > REMEMBERED:
                # Parts that come up again move back from the older half.
                self.older, self.known = self.known, {}
        return np.fromiter(chain.from_iterable(found), dtype=np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process, so that tasks share what it remembers."""
    return Encoder(vocabulary)


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if r is None else len(r) for r in rows], dtype=np.int64)
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    values = np.concatenate([r for r in rows if r is not None]) if sizes.any() else np.zeros(0, dtype=np.int32)
    lost = pa.array([r is None for r in rows])
    return pa.ListArray.from_arrays(offsets, pa.array(values), mask=lost)


def _renamed(df: DataFrame, columns: list[str]) -> tuple[dict[str, str], list]:
    names = {f"kept_{i}": c for i, c in enumerate(columns)}
    return names, [F.col(c).alias(n) for n, c in names.items()]


def encode(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", carry: tuple[str, ...] = ("doc_id",), check: bool = False
) -> DataFrame:
    """The columns ``carry`` of ``df`` with ``ids`` and ``n_ids``.

    With ``check`` also ``round_trip``: whether decoding gives the text again.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    names, columns = _renamed(df, list(carry))
    kept = df.select(F.col(text).cast("string").alias("body"), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                texts = batch.column("body").to_pylist()
                ids = [None if t is None else encoder.encode(t) for t in texts]
                sizes = pa.array([None if r is None else len(r) for r in ids], pa.int64())
                out = [*batch.columns[1:], _lists(ids), sizes]
                if check:
                    same = [None if t is None else encoder.decode(r.tolist()) == t for t, r in zip(texts, ids, strict=True)]
                    out.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(out, [*names, "ids", "n_ids", *["round_trip"] * check])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema[1:])
    found = kept.mapInArrow(run, schema + "ids array<int>, n_ids long" + ", round_trip boolean" * check)
    return found.select(*(F.col(n).alias(c) for n, c in names.items()), "ids", "n_ids", *["round_trip"] * check)


def decode(
    df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``carry`` of ``df`` with ``text``, made from the ids; null ids give a null text."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    names, columns = _renamed(df, list(carry))
    kept = df.select(F.col(ids).cast("array<int>").alias("coded"), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            texts = [None if r is None else encoder.decode(r) for r in batch.column("coded").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*names, "text"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema[1:])
    found = kept.mapInArrow(run, schema + "text string")
    return found.select(*(F.col(n).alias(c) for n, c in names.items()), "text")
