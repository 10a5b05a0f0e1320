"""Schema operators and predicates on whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text
from ..sources.contracts import as_int


def apply_aliases(df: DataFrame, aliases: Mapping[str, str] | None) -> DataFrame:
    """Rename the raw headers that are present."""
    return df.withColumnsRenamed(dict(aliases)) if aliases else df


def project(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """The requested columns in order; missing ones become empty text."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit("").alias(c) for c in keep])


def to_int(df: DataFrame, column: str) -> DataFrame:
    """Coerce to a nullable whole number; anything else becomes null."""
    return df.withColumn(column, as_int(F.col(column)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def filter_scope(
    df: DataFrame,
    value: str,
    column: str = "scope",
    drop_after: bool = True,
    trimmed: bool = False,
    before: Observation | None = None,
    after: Observation | None = None,
) -> DataFrame:
    """Rows whose stripped scope equals ``value``; unchanged without the column.

    Pass ``trimmed=True`` for a scope that is clean already: the comparison is
    then plain, so the scan prunes partitions and row groups by it. The
    observations receive the row counts ``n`` of the same job.
    """
    if column not in df.columns:
        return df
    if before is not None:
        df = observe_rows(df, before)
    scope = F.col(column) if trimmed else text.strip(F.col(column).cast("string"))
    kept = df.where(scope == F.lit(str(value)))
    if after is not None:
        kept = observe_rows(kept, after)
    return kept.drop(column) if drop_after else kept


def observe_rows(df: DataFrame, observation: Observation) -> DataFrame:
    """Count the rows that pass this point, without a job of its own."""
    return df.observe(observation, F.count(F.lit(1)).alias("n"))


def clean_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Normalise the text of the listed columns that are present."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: text.normalize_text(F.col(c)) for c in present})


def select_meta_columns(
    meta_columns: Iterable[str] | None, master: DataFrame, chapters: DataFrame
) -> tuple[list[str], list[str]]:
    """The configured metadata columns found in each of the two tables."""
    wanted = list(meta_columns or [])
    return (
        [c for c in wanted if c in master.columns],
        [c for c in wanted if c in chapters.columns],
    )


def coalesce_suffixes(df: DataFrame, column: str) -> DataFrame:
    """Merge ``column_x`` and ``column_y`` left by a join back into ``column``."""
    if column in df.columns:
        return df
    parts = [c for c in (f"{column}_x", f"{column}_y") if c in df.columns]
    if not parts:
        raise ValueError(f"missing column: {column}")
    return df.withColumn(column, F.coalesce(*map(F.col, parts))).drop(*parts)


def text_or_empty(column: str | Column) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.cast("string"), F.lit(""))
