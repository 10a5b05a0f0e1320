"""Readers for CSV and Parquet tables, catalogues and cell tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import apply_aliases, filter_scope, project, to_int
from . import contracts

MASTER_KEEP = ["scope", "group_id", "item_id", "title", "workload"]
CHAPTERS_KEEP = ["scope", "group_id", "item_id", "chapter_number", "chapter_title", "attestation"]

# Texts that stand for a missing value in a CSV cell.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_NO_NULL = "\u0001"
_EXTRA = "__extra_field"


def read_csv(
    spark: SparkSession,
    path: str,
    keep: Iterable[str] | None = None,
    aliases: Mapping[str, str] | None = None,
    *,
    sep: str = ",",
    quote: str = '"',
    encoding: str = "utf-8",
    multi_line: bool = True,
    skip_long_rows: bool | None = None,
    na_tokens: list[str] | None = None,
) -> DataFrame:
    """All columns as text; only headers that are kept or alias to a kept name.

    Rows with too few fields are padded with nulls and rows with too many are
    cut, unless ``skip_long_rows``, which is the default when all columns are
    read. Pass ``multi_line=False`` for files without line breaks inside
    quotes: Spark then splits a large file over many tasks.
    """
    kept = set(keep or [])
    if skip_long_rows is None:
        skip_long_rows = not kept
    reader = spark.read.options(
        header=True,
        sep=sep,
        quote=quote,
        escape=quote,
        encoding=encoding,
        multiLine=multi_line,
        mode="PERMISSIVE",
        nullValue=_NO_NULL,
        emptyValue="",
    )
    headers = reader.csv(path).columns
    if skip_long_rows:
        fields = [T.StructField(h, T.StringType()) for h in [*headers, _EXTRA]]
        df = reader.schema(T.StructType(fields)).csv(path)
        df = df.where(F.col(f"`{_EXTRA}`").isNull())
    else:
        df = reader.csv(path)
    names = [h for h in headers if not kept or h in kept or (aliases or {}).get(h) in kept]
    missing = NA_TOKENS if na_tokens is None else na_tokens
    return df.select(
        *[F.when(~F.col(f"`{n}`").isin(missing), F.col(f"`{n}`")).alias(n) for n in names]
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_any(
    spark: SparkSession,
    path: str,
    keep: Iterable[str] | None = None,
    aliases: Mapping[str, str] | None = None,
    **csv_options,
) -> DataFrame:
    """CSV for paths that end in ``.csv``, Parquet for all others."""
    if path.lower().endswith(".csv"):
        return read_csv(spark, path, keep, aliases, **csv_options)
    return read_parquet(spark, path)


def _load(spark, path, keep, aliases, contract, number, scope, enforce, csv_options):
    df = read_any(spark, path, keep, aliases, **csv_options)
    df = project(apply_aliases(df, aliases), keep)
    if scope is not None:
        df = filter_scope(df, scope, drop_after=False)
    if enforce:
        contracts.enforce(df, contract)
    return to_int(df, number) if number in keep else df


def load_master(
    spark: SparkSession,
    path: str,
    keep: list[str] | None = None,
    aliases: Mapping[str, str] | None = None,
    scope: str | None = None,
    enforce: bool = True,
    **csv_options,
) -> DataFrame:
    """Items: read, alias, project, check the contract, workload to a number.

    With ``scope`` only rows of that scope are read and checked.
    """
    return _load(
        spark, path, keep or MASTER_KEEP, aliases, contracts.MASTER, "workload", scope, enforce,
        csv_options,
    )


def load_chapters(
    spark: SparkSession,
    path: str,
    keep: list[str] | None = None,
    aliases: Mapping[str, str] | None = None,
    scope: str | None = None,
    enforce: bool = True,
    **csv_options,
) -> DataFrame:
    """Chapters of the items; like :func:`load_master`."""
    return _load(
        spark, path, keep or CHAPTERS_KEEP, aliases, contracts.CHAPTERS, "chapter_number", scope,
        enforce, csv_options,
    )


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """A table with an ``embedding`` array next to its key."""
    return spark.read.parquet(path)


def read_cells(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(catalog, cell centroids)`` as written by ``write_cells``."""
    return spark.read.parquet(f"{path}/members"), spark.read.parquet(f"{path}/centroids")
