"""Fingerprints of documents as Merkle trees over sections, paragraphs and spans.

A text is cut into sections at blank lines, a section into paragraphs at line
breaks, and a paragraph into spans by its content: a span ends after a word in one
of the letters ``CUTS``, or after ``LONGEST`` code points, so an inserted character
changes the spans around it and no others. The leaves are the spans' digests, the
first 16 digits of their MD5. A paragraph's digest is the MD5 of its leaves, a
section's the MD5 of its paragraphs' digests, and the root the SHA-256 of the
sections' digests: equal texts have equal roots, and roots of unlike texts agree only
if digests collide.

``likeness`` and ``differing`` walk two trees from the top and enter only branches
that the other tree does not have, wherever it has them: sections, then the
paragraphs of the sections that are left, then the leaves of the paragraphs that are
left. The likeness is the Dice coefficient of the leaves found equal on the way.
Branches are compared as the text of all leaves below them by hashed sets, so a walk is
linear in both trees.

Everything is a column expression. Neighbours in the order of the keys come from
a range partitioning of the thin keys and one table row per partition; texts are
joined on the key, and only the part of the next text that is used is sent.

Defined cases: a null text reads as empty; the empty text is one section of one
empty paragraph without spans. Two trees without spans have a likeness of 1 if they are
equal and 0 otherwise. Null keys
are the last in descending order. Rows that repeat key and text stand as one in
the order, and each of them gets the same result. A single document is its own
next one. Only key and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.session import materialize

# Letters that end a span before a blank, and the most code points of one.
CUTS = "ds"
LONGEST = 128
SPAN = rf"[^\n]{{0,{LONGEST - 2}}}?[{CUTS}] |[^\n]{{1,{LONGEST}}}"
LEAF = 16


def _joined_leaves(paragraph: Column) -> Column:
    spans = F.regexp_extract_all(paragraph, F.lit(SPAN), F.lit(0))
    return F.array_join(F.transform(spans, lambda x: F.substring(F.md5(x), 1, LEAF)), ",")


def tree(text: Column) -> Column:
    """One text per section: leaves parted by ``,``, paragraphs by ``;``."""

    def section(part: Column) -> Column:
        return F.array_join(F.transform(F.split(part, "\n", -1), _joined_leaves), ";")

    return F.transform(F.split(text, "\n\n", -1), section)


def _paragraphs(section: Column) -> Column:
    return F.split(section, ";", -1)


def section_digests(nodes: Column) -> Column:
    return F.transform(nodes, lambda s: F.md5(F.array_join(F.transform(_paragraphs(s), lambda p: F.md5(p)), ",")))


def root(nodes: Column) -> Column:
    """The fingerprint: SHA-256 over the digests of the sections."""
    return F.sha2(F.array_join(section_digests(nodes), ","), 256)


def _leaf_count(branches: Column) -> Column:
    """How many leaves lie below the branches."""

    def below(branch: Column) -> Column:
        return F.length(F.translate(branch, ",;", "")) / LEAF

    return F.aggregate(branches, F.lit(0.0), lambda n, branch: n + below(branch))


def _children(branches: Column, mark: str) -> Column:
    return F.array_remove(F.array_distinct(F.flatten(F.transform(branches, lambda b: F.split(b, mark, -1)))), "")


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of the leaves of two trees, by a walk of the branches that differ."""

    def walk(pair: Column) -> Column:
        """``(equal, left, right)``: equal leaves, and those of either tree only."""

        def paragraphs(named: Column) -> Column:
            def leaves(rest: Column) -> Column:
                common = F.array_intersect(rest["left"], rest["right"])
                return F.struct(
                    (rest["equal"] + F.size(common)).alias("equal"),
                    F.size(F.array_except(rest["left"], rest["right"])).alias("left"),
                    F.size(F.array_except(rest["right"], rest["left"])).alias("right"),
                )

            entered = F.struct(
                (named["equal"] + _leaf_count(F.array_intersect(named["left"], named["right"]))).alias("equal"),
                _children(F.array_except(named["left"], named["right"]), ",").alias("left"),
                _children(F.array_except(named["right"], named["left"]), ",").alias("right"),
            )
            return _named(entered, leaves)

        entered = F.struct(
            _leaf_count(F.array_intersect(pair["left"], pair["right"])).alias("equal"),
            _children(F.array_except(pair["left"], pair["right"]), ";").alias("left"),
            _children(F.array_except(pair["right"], pair["left"]), ";").alias("right"),
        )
        return _named(entered, paragraphs)

    def dice(found: Column) -> Column:
        total = 2.0 * found["equal"] + found["left"] + found["right"]
        return F.when(total > 0, 2.0 * found["equal"] / total).otherwise((a == b).cast("double"))

    return _named(_named(F.struct(a.alias("left"), b.alias("right")), walk), dice)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a transform over one element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def differing(a: Column, b: Column) -> Column:
    """``(section, paragraph)``, from 0, of the paragraphs of ``b`` that its differing sections do not share with ``a``'s.

    Sections that ``a`` has anywhere are not entered, so moved text does not differ.
    """
    nothing = F.array().cast("array<struct<section:int,paragraph:int>>")
    new = F.array_except(b, a)
    mine = F.array_distinct(F.flatten(F.transform(new, _paragraphs)))
    changed = F.array_except(mine, F.flatten(F.transform(F.array_except(a, b), _paragraphs)))

    def inner(section: Column, i: Column) -> Column:
        places = F.transform(
            _paragraphs(section),
            lambda p, j: F.when(F.array_contains(changed, p), F.struct(i.alias("section"), j.alias("paragraph"))),
        )
        return F.when(F.array_contains(new, section), F.filter(places, lambda p: p.isNotNull())).otherwise(nothing)

    return F.flatten(F.transform(b, inner))


def next_keys(keys: DataFrame) -> DataFrame:
    """Add ``next_key, next_hash, next_chars``: the next row by descending key.

    ``keys`` has distinct ``(row_key, row_hash)`` and ``n_chars``; the row after
    the last is the first. Each range of keys is ordered for itself; the first
    rows of the ranges, one per partition, link them.
    """
    order = [F.col("row_key").desc_nulls_last(), F.col("row_hash")]
    ranged = materialize(
        keys.repartitionByRange(*order).select(*keys.columns, F.spark_partition_id().alias("part"))
    )
    within = Window.partitionBy("part").orderBy(*order)
    entry = F.struct(F.col("row_key").alias("key"), F.col("row_hash").alias("hash"), F.col("n_chars").alias("chars"))
    listed = ranged.select("*", F.lead(entry).over(within).alias("next"), F.row_number().over(within).alias("place"))
    listed = materialize(listed.withColumn("own", entry))
    heads = listed.where("place = 1").select("part", "own")
    ring = Window.orderBy("part")
    first = F.first("own").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    links = materialize(heads.select("part", F.coalesce(F.lead("own").over(ring), first).alias("after")))
    linked = listed.join(links, "part").withColumn("next", F.coalesce("next", "after"))
    return linked.select(
        *keys.columns,
        F.col("next.key").alias("next_key"),
        F.col("next.hash").alias("next_hash"),
        F.col("next.chars").alias("next_chars"),
    )


def _identity(key: Column) -> Column:
    """A key as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    The last half of the code points (rounded down) is replaced by as many from
    the start of the next text by descending key, or by all of it.
    """
    docs = df.select(
        F.col(key).alias("row_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body")
    ).select("row_key", _identity(F.col("row_key")).alias("row_id"), "body", F.xxhash64("body").alias("row_hash"))
    keys = docs.select("row_key", "row_hash", F.length("body").alias("n_chars")).distinct()
    nexts = materialize(next_keys(keys)).select(
        "row_key",
        "n_chars",
        _identity(F.col("row_key")).alias("for_id"),
        F.col("row_hash").alias("for_hash"),
        _identity(F.col("next_key")).alias("row_id"),
        F.col("next_hash").alias("row_hash"),
    )
    # Both joins take the same columns of the texts by the same keys, so the texts are sent
    # once, and the groups are those of the second join, so they are not sent again.
    bodies = docs.select("row_id", "row_hash", "body")
    starts = (
        bodies.join(nexts, ["row_id", "row_hash"])
        .select(
            "row_key",
            "for_id",
            "for_hash",
            F.substring("body", F.lit(1), (F.col("n_chars") / 2).cast("int")).alias("start"),
            tree(F.col("body")).alias("next_tree"),
        )
        .groupBy("for_id", "for_hash")
        .agg(F.first("row_key").alias("row_key"), F.first("start").alias("start"), F.first("next_tree").alias("next_tree"))
        .withColumnsRenamed({"for_id": "row_id", "for_hash": "row_hash"})
    )
    length = F.length("body")
    edited = F.concat(F.substring("body", F.lit(1), length - (length / 2).cast("int")), F.col("start"))
    both = bodies.join(starts, ["row_id", "row_hash"]).select(
        "row_key",
        length.cast("long").alias("n_chars"),
        edited.alias("edited"),
        "next_tree",
        tree(F.col("body")).alias("own_tree"),
    )
    both = both.withColumn("edited_tree", tree(F.col("edited")))
    return both.select(
        F.col("row_key").alias(key),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        root(F.col("own_tree")).alias("fingerprint"),
        root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("own_tree"), F.col("edited_tree")).alias("near_edited"),
        likeness(F.col("own_tree"), F.col("next_tree")).alias("near_next"),
    )
