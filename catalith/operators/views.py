"""One row of assembled text per item."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .columns import select_meta_columns, text_or_empty

CHAPTER_SEPARATOR = " || "
META_SEPARATOR = " | "

# An item's chapters are sorted and joined in runs of this many numbers, so
# that an item with very many chapters is spread over many tasks.
RUN_LENGTH = 64


def _sorted_titles(kept: Column) -> Column:
    entry = F.struct(F.col("chapter_number").alias("n"), F.col("title").alias("t"))
    titles = F.array_sort(F.collect_list(F.when(kept, entry)))
    return F.array_join(F.transform(titles, lambda e: e["t"]), CHAPTER_SEPARATOR)


def _meta_values(column: str) -> Column:
    value = text.strip(text_or_empty(column))
    return F.when(value != "", value)


def summarize_chapters(
    chapters: DataFrame,
    generic: list[str] | None = None,
    meta_columns: Iterable[str] = (),
    with_titles: bool = True,
) -> DataFrame:
    """Per item: titles in chapter order and distinct metadata values.

    Generic and empty headings are left out. Ties in the number are ordered by
    title. All outputs come from one grouping of the chapters.
    """
    meta = list(meta_columns)
    rows = chapters.where(F.col("item_id").isNotNull())
    run_aggs = [F.collect_set(_meta_values(c)).alias(c) for c in meta]
    item_aggs = [
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), META_SEPARATOR)
        .alias(c)
        for c in meta
    ]
    if not with_titles:
        per_item = rows.groupBy("item_id").agg(*run_aggs)
        return per_item.withColumns(
            {c: F.array_join(F.array_sort(F.col(c)), META_SEPARATOR) for c in meta}
        )

    last = F.lit((1 << 63) - 1)
    title = text.strip(text_or_empty("chapter_title"))
    rows = rows.select(
        "item_id",
        F.coalesce(F.col("chapter_number").cast("long"), last).alias("chapter_number"),
        title.alias("title"),
        *meta,
    )
    kept = ~text.is_generic_heading(F.col("title"), generic or [])
    run = F.floor(F.col("chapter_number") / F.lit(RUN_LENGTH))
    runs = rows.groupBy("item_id", run.alias("run")).agg(
        _sorted_titles(kept).alias("titles"), *run_aggs
    )
    entry = F.struct(F.col("run"), F.col("titles"))
    joined = F.array_sort(F.collect_list(F.when(F.col("titles") != "", entry)))
    return runs.groupBy("item_id").agg(
        F.array_join(F.transform(joined, lambda e: e["titles"]), CHAPTER_SEPARATOR).alias(
            "chap_titles_text"
        ),
        *item_aggs,
    )


def chapter_titles(chapters: DataFrame, generic: list[str] | None = None) -> DataFrame:
    """``(item_id, chap_titles_text)`` for items that keep at least one title."""
    titles = summarize_chapters(chapters, generic)
    return titles.where(F.col("chap_titles_text") != "")


def meta_text(columns: list[Column]) -> Column:
    """The non-empty values, joined in order."""
    values = F.array(*[text.strip(text_or_empty(c)) for c in columns])
    return F.array_join(F.filter(values, lambda v: v != ""), META_SEPARATOR)


def item_meta(
    master: DataFrame, chapters: DataFrame, meta_columns: Iterable[str] | None
) -> DataFrame:
    """``(item_id, meta_text)`` for every item of either table.

    Master values come first, then the distinct chapter values. A column that
    both tables have contributes twice.
    """
    of_master, of_chapters = select_meta_columns(meta_columns, master, chapters)
    items = master.select("item_id", *[F.col(c).alias(f"m_{c}") for c in of_master])
    if not of_chapters:
        return items.select("item_id", meta_text([F.col(f"m_{c}") for c in of_master]).alias("meta_text"))
    values = summarize_chapters(chapters, meta_columns=of_chapters, with_titles=False)
    values = values.withColumnsRenamed({c: f"c_{c}" for c in of_chapters})
    columns = [F.col(f"m_{c}") for c in of_master] + [F.col(f"c_{c}") for c in of_chapters]
    return items.join(values, "item_id", "full").select("item_id", meta_text(columns).alias("meta_text"))


def build_views(
    master: DataFrame,
    chapters: DataFrame,
    meta_columns: Iterable[str] | None = ("workload", "attestation"),
    generic: Iterable[str] | Mapping[str, Iterable[str]] | None = (),
) -> DataFrame:
    """``(item_id, group_id, title_text, chap_titles_text, meta_text)``.

    One row per master row. Chapters are grouped once for both texts, and the
    grouping also serves the join.
    """
    of_master, of_chapters = select_meta_columns(meta_columns, master, chapters)
    values = summarize_chapters(chapters, text.generic_pool(generic), of_chapters)
    values = values.withColumnsRenamed({c: f"c_{c}" for c in of_chapters})
    columns = [F.col(c) for c in of_master] + [F.col(f"c_{c}") for c in of_chapters]
    return master.join(values, "item_id", "left").select(
        "item_id",
        "group_id",
        F.col("title").alias("title_text"),
        text_or_empty("chap_titles_text").alias("chap_titles_text"),
        (meta_text(columns) if columns else F.lit("")).alias("meta_text"),
    )
