"""From the two raw tables to one row of text per item."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation

from ..operators.columns import clean_columns, filter_scope, observe_rows
from ..operators.language import item_language
from ..operators.views import build_views
from ..sources.writers import write_table


def clean_tables(
    master: DataFrame,
    chapters: DataFrame,
    scope: str | None = None,
    drop_scope: bool = True,
    trimmed: bool = False,
    counts: dict[str, Observation] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Normalised text columns, restricted to one scope if given.

    With ``trimmed`` the scope has no spaces around it, so that scans prune by it.
    ``counts`` may hold observations for the row counts ``n`` of ``master_in``,
    ``master_out``, ``chapters_in`` and ``chapters_out``.
    """
    counts = counts or {}
    tables = {"master": master, "chapters": chapters}
    for name, table in tables.items():
        before, after = counts.get(f"{name}_in"), counts.get(f"{name}_out")
        if scope is not None:
            table = filter_scope(table, scope, drop_after=drop_scope, trimmed=trimmed, before=before, after=after)
        else:
            table = observe_rows(table, before) if before else table
            table = observe_rows(table, after) if after else table
        tables[name] = table
    master, chapters = tables["master"], tables["chapters"]
    return (
        clean_columns(master, ["title"]),
        clean_columns(chapters, ["chapter_title", "attestation"]),
    )


def prepare(
    master: DataFrame,
    chapters: DataFrame,
    scope: str | None = None,
    meta_columns: Iterable[str] | None = ("workload", "attestation"),
    generic: Iterable[str] | Mapping[str, Iterable[str]] | None = (),
    profiles: DataFrame | None = None,
    out: str | None = None,
    trimmed: bool = False,
    counts: dict[str, Observation] | None = None,
) -> DataFrame:
    """Views of the items, with languages if ``profiles`` are given.

    With ``out`` the cleaned tables and the views are written below it. See
    :func:`clean_tables` for ``trimmed`` and ``counts``.
    """
    master, chapters = clean_tables(master, chapters, scope, trimmed=trimmed, counts=counts)
    if out is not None:
        write_table(master, f"{out}/master", ["scope"] if "scope" in master.columns else None)
        write_table(chapters, f"{out}/chapters", ["scope"] if "scope" in chapters.columns else None)
        master = master.sparkSession.read.parquet(f"{out}/master")
        chapters = chapters.sparkSession.read.parquet(f"{out}/chapters")
    views = build_views(master, chapters, meta_columns, generic)
    if profiles is not None:
        views = item_language(views, profiles)
    if out is not None:
        write_table(views, f"{out}/views")
        views = views.sparkSession.read.parquet(f"{out}/views")
    return views
