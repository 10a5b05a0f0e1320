"""Language of texts by interpolated Kneser-Ney character models.

Each language has a model of ``ORDER`` characters, with absolute discounts and
continuation counts. Characters are lower-case letters; anything else counts as
one space. The probabilities of all languages for every character sequence that
some language has seen stand side by side, in arrays sorted by the hash of the
sequence. What a language has not seen follows from its weights for shorter
contexts, which the tables of the lower orders hold in the same form.

A text goes to the language of the lowest cross-entropy per character. The
rejection is calibrated on texts that are left out of the fit. The excess of a text
is its cross-entropy less the mean of its language's texts, over ``sqrt(1 + CHANCE /
characters)``, as chance moves short texts further. The excess of a foreign text is
what it has under its best language when the model of its own is left out, each
language in turn. A text is rejected if it has no letter, or if its excess is above
a limit: half way between the ``1 - REFUSED`` quantile of own texts (the largest of
the languages) and the ``FOREIGN`` quantile of foreign ones (the least of the
languages left out), and never below the former. So of the texts of any language a
share of at most ``REFUSED`` (0.5 percent) of those left out is rejected, and of new
ones about 1 / (n + 1) at most where n, the number left out, is below 200. If
the two quantiles are apart, at most ``FOREIGN`` (5 percent) of the texts of a
language left out stay. With a single language nothing can be left out; a text that
fits twice as badly as the mean stands for the foreign ones.

Defined cases: a null text, and one without letters, has the language ``und``, a
score of 0 and is rejected. Rows with a null language are not learned from.
Equal cross-entropies go to the language that is first by name. Without any
labelled text every language is ``und``. Only the named columns are read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.session import materialize

ORDER = 4
#: Texts per language that the models are fitted on, on average.
DOCS = 2000
CHUNK = 1 << 19
#: Share of the texts left out, and the least number of texts (of up to half) that are.
LEFT_OUT, LEAST_LEFT_OUT = 0.1, 40
#: Share of own texts that the limit may reject, and of foreign texts that it may keep.
REFUSED, FOREIGN = 0.005, 0.05
#: Characters at which chance moves the cross-entropy as far as texts differ.
CHANCE = 30
#: Characters after which more text does not raise the score.
EVIDENCE = 40
UNKNOWN = "und"
SPACE = 32
RESULT = "language string, score double, entropy double, rejected boolean"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_folded: np.ndarray | None = None


def folded() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    global _folded
    if _folded is None:
        table = np.full(0x110000, SPACE, dtype=np.uint32)
        for code in range(0x110000):
            if unicodedata.category(chr(code))[0] in "LM":
                low = chr(code).lower()
                table[code] = ord(low) if len(low) == 1 else code
        _folded = table
    return _folded


def characters(text: str) -> np.ndarray:
    """Letters of ``text`` with single spaces between and around words; empty without letters."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = folded()[codes]
    gap = codes == SPACE
    if gap.all():
        return codes[:0]
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    codes = codes[keep]
    lead = [] if codes[0] == SPACE else [SPACE]
    tail = [] if codes[-1] == SPACE else [SPACE]
    return np.concatenate((np.array(lead, np.uint32), codes, np.array(tail, np.uint32)))


def gram_hashes(codes: np.ndarray, order: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the runs of ``order`` characters at ``starts``, or of all runs."""
    n = max(len(codes) - order + 1, 0) if starts is None else len(starts)
    total = np.full(n, order, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(order):
            total = (total ^ (codes[i : i + n] if starts is None else codes[starts + i])) * _FACTOR
            total ^= total >> np.uint64(29)
    return total


def _hash_of(grams: list[str]) -> np.ndarray:
    order = len(grams[0])
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "replace"), dtype=np.uint32)
    return gram_hashes(codes, order)[::order] if order > 1 else gram_hashes(codes, 1)


class KneserNey:
    """One language: counts of runs of ``ORDER`` characters and what follows from them."""

    def __init__(self, counts: dict[str, int]):
        self.counts: list[dict[str, int]] = [dict() for _ in range(ORDER + 1)]
        self.counts[ORDER] = counts
        for order in range(ORDER, 1, -1):
            # How many characters precede the run, instead of how often it occurs.
            self.counts[order - 1] = Counter(gram[1:] for gram in self.counts[order])
        self.total: list[dict[str, int]] = [dict() for _ in range(ORDER + 1)]
        self.kinds: list[dict[str, int]] = [dict() for _ in range(ORDER + 1)]
        self.discount = [0.0] * (ORDER + 1)
        for order in range(1, ORDER + 1):
            total, kinds = defaultdict(int), defaultdict(int)
            for gram, n in self.counts[order].items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            self.total[order], self.kinds[order] = total, kinds
            of = Counter(self.counts[order].values())
            self.discount[order] = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.5
        self.alphabet = max(256, 2 * len(self.counts[1]))

    def weight(self, context: str) -> float:
        """What the context leaves to the shorter one; 1 if it was not seen."""
        order = len(context) + 1
        total = self.total[order].get(context)
        return self.discount[order] * self.kinds[order][context] / total if total else 1.0

    def probability(self, gram: str) -> float:
        order = len(gram)
        lower = self.probability(gram[1:]) if order > 1 else 1 / self.alphabet
        context = gram[:-1]
        total = self.total[order].get(context)
        if not total:
            return lower
        own = max(self.counts[order].get(gram, 0) - self.discount[order], 0) / total
        return own + self.weight(context) * lower


class Models:
    """The models of all languages in sorted hash arrays, with their calibration."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.languages = sorted(counts)
        models = [KneserNey(counts[name]) for name in self.languages]
        self.grams, self.contexts = [], []
        for order in range(1, ORDER + 1) if models else ():
            seen = sorted({g for m in models for g in m.counts[order]})
            self.grams.append(self._sorted(seen, lambda m, g: m.probability(g), models))
            heads = sorted({c for m in models for c in m.total[order]})
            self.contexts.append(self._sorted(heads, lambda m, c: m.weight(c), models))
        self.unseen = np.log([1 / m.alphabet for m in models])
        self.mean = np.zeros(len(models))
        self.limit = np.inf

    @staticmethod
    def _sorted(grams: list[str], value, models: list[KneserNey]) -> tuple[np.ndarray, np.ndarray]:
        logs = np.log(np.array([[value(m, g) for m in models] for g in grams], dtype=np.float64)).astype(np.float32)
        hashes = np.zeros(1, np.uint64) if grams == [""] else _hash_of(grams)
        order = np.argsort(hashes)
        return hashes[order], logs[order]

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Of each character after the first ``ORDER - 1``, by language."""
        n = len(codes) - ORDER + 1
        out = np.zeros((n, len(self.languages)), dtype=np.float32)
        missing = np.arange(n)
        for order in range(ORDER, 0, -1):
            starts = None if order == ORDER else missing + ORDER - order
            wanted = gram_hashes(codes, order, starts)
            table, logs = self.grams[order - 1]
            at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
            found = table[at] == wanted
            out[missing[found]] += logs[at[found]]
            missing = missing[~found]
            if not len(missing):
                return out
            heads, weights = self.contexts[order - 1]
            if order == 1:
                out[missing] += weights[0] + self.unseen.astype(np.float32)
                return out
            wanted = gram_hashes(codes, order - 1, missing + ORDER - order)
            at = np.minimum(np.searchsorted(heads, wanted), len(heads) - 1)
            known = heads[at] == wanted
            out[missing[known]] += weights[at[known]]
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character by language, and the number of characters."""
        sums = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), dtype=np.int64)
        held, owner, length = [], [], 0

        def flush() -> None:
            nonlocal held, owner, length
            if not held:
                return
            # Each piece starts with a context of spaces or of its own last characters.
            starts = np.cumsum([0] + [len(p) for p in held])
            logs = self.log_probabilities(np.concatenate(held))
            for i, (piece, start) in enumerate(zip(held, starts, strict=False)):
                sums[owner[i]] += logs[start : start + len(piece) - ORDER + 1].sum(axis=0, dtype=np.float64)
            held, owner, length = [], [], 0

        pad = np.full(ORDER - 1, SPACE, dtype=np.uint32)
        for i, text in enumerate(texts):
            codes = characters(text) if text else np.zeros(0, np.uint32)
            if not len(codes):
                continue
            codes = np.concatenate((pad, codes[1:]))
            sizes[i] = len(codes) - ORDER + 1
            for start in range(0, len(codes) - ORDER + 1, CHUNK):
                held.append(codes[start : start + CHUNK + ORDER - 1])
                owner.append(i)
                length += len(held[-1])
                if length >= CHUNK:
                    flush()
        flush()
        return -sums / np.maximum(sizes, 1)[:, None], sizes

    def calibrate(self, entropy: np.ndarray, sizes: np.ndarray, languages: list[str]) -> None:
        """Means and the limit of the excess, from the ``entropies`` of texts left out of the fit."""
        known = sizes > 0
        entropy, sizes, names = entropy[known], sizes[known], np.array(languages, dtype=object)[known]
        self.mean = np.full(len(self.languages), np.inf)
        for k, name in enumerate(self.languages):
            if (names == name).any():
                self.mean[k] = np.average(entropy[names == name, k], weights=sizes[names == name])
        own, foreign = [], []
        for k, name in enumerate(self.languages):
            rows = names == name
            if not rows.any():
                continue
            stretch = np.sqrt(1 + CHANCE / sizes[rows])
            excess = (entropy[rows, k] - self.mean[k]) / stretch
            own.append(np.quantile(excess, 1 - REFUSED, method="higher"))
            others = np.delete(entropy[rows], k, axis=1)
            if others.shape[1]:
                best = others.argmin(axis=1)
                excess = (others.min(axis=1) - np.delete(self.mean, k)[best]) / stretch
                foreign.append(np.quantile(excess, FOREIGN, method="lower"))
            else:
                foreign.append(self.mean[k])
        if own:
            self.limit = max(max(own), (max(own) + min(foreign)) / 2)

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        if not self.languages:
            n = len(texts)
            return [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, dtype=bool)
        entropy, sizes = self.entropies(texts)
        best = entropy.argmin(axis=1)
        known = sizes > 0
        rows = np.arange(len(texts))
        lowest = entropy[rows, best]
        evidence = np.minimum(sizes, EVIDENCE)[:, None]
        score = 1 / np.exp((lowest[:, None] - entropy) * evidence).sum(axis=1)
        # Nothing is known of how texts of a language fit if none was left out.
        excess = np.where(np.isfinite(self.mean[best]), lowest - self.mean[best], -np.inf)
        far = excess > self.limit * np.sqrt(1 + CHANCE / np.maximum(sizes, 1))
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, np.where(known, score, 0.0), np.where(known, lowest, np.nan), ~known | far


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs of ``ORDER`` characters per language, summed within the task."""
    found: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist(), strict=True):
            codes = characters(text) if text else ()
            if len(codes):
                line = np.concatenate((np.full(ORDER - 1, SPACE, np.uint32), codes[1:])).tobytes().decode("utf-32-le")
                found[lang].update(line[i : i + ORDER] for i in range(len(line) - ORDER + 1))
    for lang, grams in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())],
            ["lang", "gram", "n"],
        )


def train(df: DataFrame, text: str = "text", lang: str = "lang", docs: int = DOCS) -> Models:
    """Models of the languages of ``df``, from about ``docs`` texts of each."""
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("body")
    )
    rows = rows.withColumn("hash", F.xxhash64("body"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang", "hash").count().groupBy("lang").agg(F.count("*").alias("count")).collect()}
    share, left = F.lit(0.0), F.lit(0.0)
    for name, count in sizes.items():
        this = F.col("lang") == name
        part = min(0.5, max(LEFT_OUT, LEAST_LEFT_OUT / min(count, docs)))
        share = F.when(this, F.lit(min(1.0, docs / count))).otherwise(share)
        left = F.when(this, F.lit(min(1.0, docs / count) * part)).otherwise(left)
    place = F.shiftrightunsigned("hash", 11) / float(1 << 53)
    drawn = rows.withColumn("place", place).where(F.col("place") < share).dropDuplicates(["lang", "hash"])
    drawn = materialize(drawn.select("lang", "body", (F.col("place") < left).alias("out")))
    grams = drawn.where("not out").select("lang", "body").mapInArrow(_count_grams, "lang string, gram string, n long")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    # Bounded by the texts drawn.
    summed = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    for name, gram, n in zip(*(summed.column(c).to_pylist() for c in ("lang", "gram", "n")), strict=True):
        counts[name][gram] = n
    models = Models(counts)
    if not counts:
        return models
    shared = df.sparkSession.sparkContext.broadcast(models)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                entropy, letters = shared.value.entropies(batch.column("body").to_pylist())
                values = pa.array(entropy.tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(letters), values], ["lang", "letters", "entropy"])

    held = drawn.where("out").select("lang", "body").mapInArrow(measure, "lang string, letters long, entropy array<double>").toArrow()
    entropy = np.array(held.column("entropy").to_pylist(), dtype=np.float64).reshape(-1, len(models.languages))
    models.calibrate(entropy, held.column("letters").to_numpy(), held.column("lang").to_pylist())
    return models


def predict(df: DataFrame, models: Models, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df``, or all, with ``language, score, entropy, rejected``.

    Columns of ``df`` that have one of these four names must not be carried.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)
    carry = df.columns if carry is None else carry
    names = {f"kept_{i}": c for i, c in enumerate(carry)}
    kept = df.select(F.col(text).cast("string").alias("body"), *(F.col(c).alias(n) for n, c in names.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                language, score, entropy, rejected = shared.value.classify(batch.column("body").to_pylist())
                columns = [pa.array(language, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], *columns], [*names, "language", "score", "entropy", "rejected"]
                )

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema[1:])
    found = kept.mapInArrow(run, schema + RESULT)
    return found.select(*(F.col(n).alias(c) for n, c in names.items()), "language", "score", "entropy", "rejected")


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: its key's CRC is a multiple of 5."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def training_rows(df: DataFrame, key: str = "doc_id") -> DataFrame:
    return df.where(F.col(key).isNotNull() & ~held_out(F.col(key)))


def language_report(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(key, held_out, lang_pred, score, rejected)`` of every row."""
    models = train(training_rows(df, key), text, lang)
    rows = df.select(F.col(key).alias("row_key"), F.col(text).cast("string").alias("body"))
    found = predict(rows, models, "body", ["row_key"])
    return found.select(
        F.col("row_key").alias(key),
        held_out(F.col("row_key")).alias("held_out"),
        F.col("language").alias("lang_pred"),
        "score",
        "rejected",
    )


def keep_known(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` whose text is not rejected, unchanged."""
    models = train(training_rows(df, key), text, lang)
    names = {f"own_{i}": c for i, c in enumerate(df.columns)}
    found = predict(df.select(*(F.col(c).alias(n) for n, c in names.items()), F.col(text).alias("body")), models, "body", list(names))
    return found.where(~F.col("rejected")).select(*(F.col(n).alias(c) for n, c in names.items()))
