"""Queries on the item and chapter tables: reading, checking, assembling text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalith.functions import text
from catalith.operators import columns, views
from catalith.plans.prepare import prepare
from catalith.session import shared_folder
from catalith.sources import contracts, readers, writers

from .tables import (
    DOCUMENT_VIEWS_SQL,
    GENERIC_LINES,
    GENERIC_PARTS,
    GENERIC_SQL,
    ORDER_CHAPTERS_SQL,
    WHITESPACE_SQL,
    document_chapters,
    document_items,
    order_chapters,
    order_items,
    read,
)

ORDER_ALIASES = {
    "o_orderstatus": "scope",
    "o_orderpriority": "group_id",
    "o_orderkey": "item_id",
    "o_totalprice": "workload",
    "not_there": "title",
}


def scan_alias_project(spark, folder):
    orders = columns.apply_aliases(read(spark, folder, "orders"), ORDER_ALIASES)
    return columns.project(orders, readers.MASTER_KEEP)


def coerce_numeric(spark, folder):
    price = F.col("o_totalprice")
    raw = (
        F.when(F.col("o_orderpriority").startswith("1"), F.lit("n/a"))
        .when(F.col("o_orderpriority").startswith("2"), price.cast("string"))
        .otherwise(F.concat(F.lit(" "), F.floor(price).cast("string"), F.lit(".0")))
    )
    rows = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("item_id"), raw.alias("workload")
    )
    return columns.to_int(rows, "workload")


def contract_violations(spark, folder):
    status = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("item_id"),
        F.col("o_orderstatus").alias("scope"),
        F.col("o_orderpriority").alias("group_id"),
    )
    chapters = order_chapters(spark, folder).join(status, "item_id")
    raw = chapters.withColumns(
        {
            "scope": F.nullif("scope", F.lit("P")),
            "chapter_number": F.when(
                F.col("attestation") == "A", F.col("chapter_number") - 1
            ).otherwise(F.col("chapter_number") / 2).cast("string"),
            "chapter_title": F.when(F.col("chapter_title") == "hot bolt", F.lit(""))
            .when(F.col("chapter_title") != "red widget", F.col("chapter_title")),
        }
    )
    return contracts.violations(raw, contracts.CHAPTERS)


def duplicate_keys(spark, folder):
    return columns.duplicate_keys(order_chapters(spark, folder), ["item_id", "chapter_number"])


def filter_scope(spark, folder):
    padded = F.concat(F.lit("\t"), F.col("scope"), F.lit("  "))
    items = order_items(spark, folder).withColumn("scope", padded)
    return columns.filter_scope(items, "F")


def normalize_text(spark, folder):
    raw = F.replace(F.col("text"), F.lit("\u00e9"), F.lit("e\u0301"))
    raw = F.replace(raw, F.lit(" a"), F.lit("\u00a0\u2003\ta"))
    rows = read(spark, folder, "documents").select("doc_id", raw.alias("text"))
    return columns.clean_columns(rows, ["text", "absent"])


def generic_headings(spark, folder):
    pool = text.generic_pool(GENERIC_PARTS)
    rows = order_chapters(spark, folder)
    generic = text.is_generic_heading(F.col("chapter_title"), pool)
    return rows.groupBy("chapter_title", generic.alias("generic")).agg(
        F.count(F.lit(1)).alias("n")
    )


def chapter_concat(spark, folder):
    return views.chapter_titles(order_chapters(spark, folder), text.generic_pool(GENERIC_PARTS))


def meta_distinct_concat(spark, folder):
    return views.item_meta(
        order_items(spark, folder),
        order_chapters(spark, folder),
        ["workload", "attestation", "absent"],
    )


def order_views(spark, folder):
    return views.build_views(
        order_items(spark, folder),
        order_chapters(spark, folder),
        ["workload", "attestation"],
        GENERIC_PARTS,
    )


def scope_views(spark, folder):
    """The flagship: one scope, cleaned, assembled into one row per item."""
    scopes = order_items(spark, folder).select("item_id", "scope")
    chapters = order_chapters(spark, folder).join(scopes, "item_id")
    return prepare(
        order_items(spark, folder), chapters, "F", ["workload", "attestation"], GENERIC_PARTS, trimmed=True
    )


def document_views(spark, folder):
    return views.build_views(
        document_items(spark, folder), document_chapters(spark, folder), ["workload"], GENERIC_LINES
    )


def csv_items(spark, folder):
    """Orders written as CSV with raw headers and read back through the contract."""
    path = f"{shared_folder(spark)}/catalith-csv-{uuid.uuid4().hex}.csv"
    raw = order_items(spark, folder).select(
        F.col("scope").alias("AC"),
        F.col("group_id").alias("GROUP"),
        F.col("item_id").alias("ITEM"),
        F.concat(F.lit('a "quoted", '), F.col("title"), F.lit("\nsecond line")).alias("TITLE"),
        F.when(F.col("workload") > 100000, F.col("workload")).alias("WORKLOAD"),
        F.lit("x").alias("EXTRA"),
    )
    raw.write.option("header", True).option("escape", '"').csv(path)
    aliases = {"AC": "scope", "GROUP": "group_id", "ITEM": "item_id"}
    aliases |= {"TITLE": "title", "WORKLOAD": "workload"}
    items = readers.load_master(spark, path, aliases=aliases)
    return items.withColumn("item_id", F.col("item_id").cast("long"))


def matched_vectors(spark, folder):
    """Keys of ``labels`` and ``documents`` that the other table lacks."""
    return writers.unmatched_keys(
        read(spark, folder, "labels").select("doc_id"),
        read(spark, folder, "documents").select("doc_id"),
        "doc_id",
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_alias_project,
        coerce_numeric,
        contract_violations,
        duplicate_keys,
        filter_scope,
        normalize_text,
        generic_headings,
        chapter_concat,
        meta_distinct_concat,
        order_views,
        scope_views,
        document_views,
        csv_items,
        matched_vectors,
    )
}

_ORDER_VIEWS = f"""
WITH {ORDER_CHAPTERS_SQL},
titles AS (
  SELECT item_id, string_agg(chapter_title, ' || ' ORDER BY chapter_number, chapter_title) AS t
  FROM chapters WHERE NOT {GENERIC_SQL} GROUP BY item_id),
marks AS (
  SELECT item_id, string_agg(DISTINCT attestation, ' | ' ORDER BY attestation) AS m
  FROM chapters GROUP BY item_id)
SELECT o_orderkey AS item_id, o_orderpriority AS group_id, o_orderpriority AS title_text,
       coalesce(t, '') AS chap_titles_text,
       concat_ws(' | ', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), m) AS meta_text
FROM orders LEFT JOIN titles ON o_orderkey = titles.item_id
LEFT JOIN marks ON o_orderkey = marks.item_id
"""

ORACLES = {
    "scan_alias_project": """
SELECT o_orderstatus AS scope, o_orderpriority AS group_id, o_orderkey AS item_id,
       '' AS title, o_totalprice AS workload
FROM orders""",
    "coerce_numeric": """
WITH raw AS (
  SELECT o_orderkey AS item_id,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'n/a'
              WHEN o_orderpriority LIKE '2%' THEN CAST(o_totalprice AS VARCHAR)
              ELSE ' ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '.0' END AS v
  FROM orders)
SELECT item_id,
       CASE WHEN try_cast(v AS DOUBLE) = floor(try_cast(v AS DOUBLE))
            THEN CAST(try_cast(v AS DOUBLE) AS BIGINT) END AS workload
FROM raw""",
    "contract_violations": f"""
WITH {ORDER_CHAPTERS_SQL},
raw AS (
  SELECT nullif(o_orderstatus, 'P') AS scope,
         CASE WHEN attestation = 'A' THEN chapter_number - 1.0 ELSE chapter_number / 2.0 END AS num,
         CASE WHEN chapter_title = 'hot bolt' THEN ''
              WHEN chapter_title <> 'red widget' THEN chapter_title END AS title
  FROM chapters JOIN orders ON item_id = o_orderkey),
found AS (
  SELECT unnest(list_filter([
    CASE WHEN scope IS NULL THEN 'scope.not_null' END,
    CASE WHEN num <> floor(num) THEN 'chapter_number.whole_number' END,
    CASE WHEN num = floor(num) AND num < 1 THEN 'chapter_number.at_least_1' END,
    CASE WHEN title IS NULL THEN 'chapter_title.not_null' END,
    CASE WHEN title = '' THEN 'chapter_title.min_length_1' END], lambda r: r IS NOT NULL)) AS rule
  FROM raw)
SELECT rule, count(*) AS n FROM found GROUP BY rule""",
    "duplicate_keys": f"""
WITH {ORDER_CHAPTERS_SQL}
SELECT item_id, CAST(chapter_number AS BIGINT) AS chapter_number, count(*) AS n FROM chapters
GROUP BY ALL HAVING count(*) > 1""",
    "filter_scope": """
SELECT o_orderpriority AS group_id, o_orderkey AS item_id, o_orderpriority AS title,
       CAST(floor(o_totalprice) AS BIGINT) AS workload
FROM orders WHERE o_orderstatus = 'F'""",
    "normalize_text": f"""
SELECT doc_id, trim(regexp_replace(
         nfc_normalize(replace(replace(text, 'é', 'e' || chr(769)),
                               ' a', chr(160) || chr(8195) || chr(9) || 'a')),
         '{WHITESPACE_SQL}+', ' ', 'g')) AS text
FROM documents""",
    "generic_headings": f"""
WITH {ORDER_CHAPTERS_SQL}
SELECT chapter_title, ({GENERIC_SQL} OR length(trim(chapter_title)) < 2) AS generic, count(*) AS n
FROM chapters GROUP BY ALL""",
    "chapter_concat": f"""
WITH {ORDER_CHAPTERS_SQL}
SELECT item_id,
       string_agg(chapter_title, ' || ' ORDER BY chapter_number, chapter_title) AS chap_titles_text
FROM chapters WHERE NOT {GENERIC_SQL} GROUP BY item_id""",
    "meta_distinct_concat": f"""
WITH {ORDER_CHAPTERS_SQL},
marks AS (
  SELECT item_id, string_agg(DISTINCT attestation, ' | ' ORDER BY attestation) AS m
  FROM chapters GROUP BY item_id)
SELECT coalesce(o_orderkey, item_id) AS item_id,
       concat_ws(' | ', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), m) AS meta_text
FROM orders FULL JOIN marks ON o_orderkey = item_id""",
    "order_views": _ORDER_VIEWS,
    "scope_views": _ORDER_VIEWS + "WHERE o_orderstatus = 'F'",
    "document_views": f"""
WITH {DOCUMENT_VIEWS_SQL}
SELECT item_id, group_id, title_text, chap_titles_text, meta_text FROM views""",
    "csv_items": """
SELECT o_orderstatus AS scope, o_orderpriority AS group_id, o_orderkey AS item_id,
       'a "quoted", ' || o_orderpriority || chr(10) || 'second line' AS title,
       CASE WHEN floor(o_totalprice) > 100000 THEN CAST(floor(o_totalprice) AS BIGINT) END AS workload
FROM orders""",
    "matched_vectors": """
SELECT 'items' AS side, count(*) AS n FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) HAVING count(*) > 0
UNION ALL
SELECT 'vectors', count(*) FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM documents) HAVING count(*) > 0""",
}
