"""Mixing sources to target sizes by entropy balancing.

Each source has a target number of words. The rates of its documents are the
ones closest to 1 in relative entropy, at most ``most`` each, whose words sum up
to the target. Their form is ``min(most, exp(lambda * size / mean))``, with one
``lambda`` per source that solves the convex dual: Newton steps, kept inside a
bracket, on sums over the counts of ``(source, size)``.

Rates become whole copies by ``floor(rate + shift + u)``: ``u`` in [0, 1) is a
hash of the document, and ``shift`` is one small number per source, found by
narrowing an interval on sums of whole copies, so that the copies reach the
target up to one document. A second such number for the documents that fit the
rest fills most of it.

No job sorts or groups documents: every sum is aggregated in the task first.
State is one row per source and passes from step to step as a written table;
Spark broadcasts it while its files are small and joins it otherwise. Only the
ranks of the sources, one row each, are ordered in one task.

Defined cases: a null text has size 0; a document of size 0 is copied once and
counts nothing. Null is a source of its own, the last in order. A source without
words has the target 0. Equal rows get equal copies. An empty table gives no
rows. Only the key, text and source are read for the sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
TOLERANCE = 1e-9
MAX_STEPS = 60
PROBES = 16
NARROWINGS = 5


def word_count(text: Column) -> Column:
    """Words separated by ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _uniform(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the values only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / float(1 << 53)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to one row per source: shares by weight, none above ``most`` times its size.

    The level is the number of words per unit of weight at which the sources
    below their limit take what the limited ones leave.
    """
    name = Window.orderBy(F.col("source_key") == "", "source_key")
    full = Window.orderBy("ratio", "source_key")
    whole = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(name) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * most)
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(after))
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(whole)
    ranked = ranked.withColumn("target", F.least(F.col("limit").cast("double"), level * F.col("weight")))
    return ranked.drop("weight", "limit", "ratio", "level")


def _rate(size: Column, most: int) -> Column:
    # The exponent stops at log(most), so it cannot overflow.
    return F.exp(F.least(F.col("tilt") * size / F.col("mean"), F.lit(math.log(most))))


def balance(counts: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """One row per source with ``tilt``, the solution of its dual.

    ``counts`` is ``(source_key, size, n)`` without size 0; ``targets`` has
    ``source_key, source_size, mean, least, target``.
    """
    top = F.lit(math.log(most)) * F.col("mean") / F.col("least") * (1 + 1e-9)
    share = F.col("target") / F.col("source_size")
    state = targets.where("source_size > 0").select(
        *targets.columns,
        F.least(F.lit(0.0), F.log(share) * F.col("mean") / F.col("least")).alias("low"),
        top.alias("high"),
        F.when(share >= most * (1 - 1e-12), top).otherwise(F.lit(0.0)).alias("tilt"),
        F.lit(1.0).alias("gap"),
    )
    columns = state.columns
    state = materialize(state)
    for _ in range(MAX_STEPS):
        rate = _rate(F.col("size"), most)
        words = F.col("n") * F.col("size") * rate
        bends = F.col("tilt") * F.col("size") / F.col("mean") < math.log(most)
        sums = (
            counts.join(state, "source_key")
            .groupBy(*columns)
            .agg(
                (F.sum(words) - F.col("target")).alias("excess"),
                F.sum(F.when(bends, words * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))).alias("slope"),
            )
        )
        low = F.when(F.col("excess") <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("excess") >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - F.col("excess") / F.col("slope"))
        gap = F.abs(F.col("excess")) / F.col("target")
        moved = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        state = materialize(
            sums.select(
                *targets.columns,
                low.alias("low"),
                high.alias("high"),
                F.when(gap <= TOLERANCE, F.col("tilt")).otherwise(moved).alias("tilt"),
                gap.alias("gap"),
            )
        )
        if (state.agg(F.max("gap")).first()[0] or 0) <= TOLERANCE:
            break
    # Sums of doubles may differ in the last digits from run to run.
    return state.select(*targets.columns, F.round("tilt", 9).alias("tilt"))


def _copies(shift: Column, fine: Column, most: int) -> Column:
    """Whole copies; ``fine`` counts for documents that fit the remaining gap."""
    small = F.when(F.col("size") <= F.col("room"), fine).otherwise(F.lit(0.0))
    rate = F.least(F.lit(float(most)), F.greatest(F.lit(0.0), _rate(F.col("size"), most) + shift + small))
    return F.floor(rate + F.col("uniform"))


def _narrowed(thin: DataFrame, state: DataFrame, most: int, fine: bool) -> DataFrame:
    """Raise ``low`` to the last point that does not take more than the target.

    ``room`` is what then remains. The number of copies does not fall as the
    point rises, so the point is found by narrowing.
    """
    columns = [c for c in state.columns if c not in ("low", "high", "left")]
    for _ in range(NARROWINGS):
        points = [F.col("low") + (F.col("high") - F.col("low")) * (k / PROBES) for k in range(PROBES + 1)]
        copies = [_copies(F.col("shift"), p, most) if fine else _copies(p, F.lit(0.0), most) for p in points]
        sums = (
            thin.where("size > 0")
            .join(state, "source_key")
            .groupBy(*columns, "low", "high")
            .agg(*(F.sum(F.col("size") * c).alias(f"taken_{k}") for k, c in enumerate(copies)))
        )
        low, high, taken = points[0], points[1], F.col("taken_0")
        for k in range(1, PROBES):
            fits = F.col(f"taken_{k}") <= F.col("target")
            low, high = F.when(fits, points[k]).otherwise(low), F.when(fits, points[k + 1]).otherwise(high)
            taken = F.when(fits, F.col(f"taken_{k}")).otherwise(taken)
        left = F.col("target") - taken
        state = materialize(sums.select(*columns, low.alias("low"), high.alias("high"), left.alias("left")))
    return state


def _shifted(thin: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Add ``shift``, ``room`` and ``fine`` per source so that copies meet the target."""
    columns = state.columns
    zero = F.lit(0.0)
    first = state.select(
        *columns, zero.alias("room"), zero.alias("shift"), F.lit(-float(most)).alias("low"), F.lit(float(most)).alias("high")
    )
    found = _narrowed(thin, materialize(first), most, fine=False)
    second = found.select(
        *columns, F.col("left").alias("room"), F.col("low").alias("shift"), zero.alias("low"), F.lit(1.0).alias("high")
    )
    found = _narrowed(thin, materialize(second), most, fine=True)
    return found.select(*columns, "room", "shift", F.col("low").alias("fine"))


def fit_mixture(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
) -> tuple[DataFrame, DataFrame]:
    """The documents as ``(row_key, source_key, size, uniform)`` and the rules per source."""
    thin = materialize(
        df.select(
            F.col(key).alias("row_key"),
            _source_key(F.col(source)).alias("source_key"),
            word_count(F.col(text)).alias("size"),
            _uniform(F.col(key), F.col(text)).alias("uniform"),
        )
    )
    counts = materialize(thin.groupBy("source_key", "size").agg(F.count("*").alias("n")))
    sizes = counts.groupBy("source_key").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        (F.sum(F.col("n") * F.col("size")) / F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
    )
    targets = materialize(source_targets(sizes, weights, most))
    solved = _shifted(thin, balance(counts.where("size > 0"), targets, most), most)
    rules = targets.join(solved.select("source_key", "tilt", "room", "shift", "fine"), "source_key", "left")
    return thin, materialize(rules)


def mix_report(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(key, size, source_size, target, taken, copies)`` of every document."""
    thin, rules = fit_mixture(df, key, text, source)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(_copies(F.col("shift"), F.col("fine"), MOST))
    return thin.join(rules, "source_key").select(
        F.col("row_key").alias(key),
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
    )


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``df``, each as often as the mixture takes it."""
    _, rules = fit_mixture(df, key, text, source)
    names = {c: f"doc_{i}" for i, c in enumerate(df.columns)}
    docs = df.select(*(F.col(c).alias(n) for c, n in names.items())).select(
        "*",
        _source_key(F.col(names[source])).alias("source_key"),
        word_count(F.col(names[text])).alias("size"),
        _uniform(F.col(names[key]), F.col(names[text])).alias("uniform"),
    )
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(_copies(F.col("shift"), F.col("fine"), MOST)).cast("int")
    taken = docs.join(rules, "source_key").withColumn("copies", copies).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        *(F.col(n).alias(c) for c, n in names.items())
    )
