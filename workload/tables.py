"""The given tables seen as items, chapters and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.session import spread


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_wide(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of long rows, of which a file of one row group has too many for a task."""
    return spread(read(spark, folder, table))


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as items: scope is the status and group the priority."""
    return read(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("scope"),
        F.col("o_orderpriority").alias("group_id"),
        F.col("o_orderkey").alias("item_id"),
        F.col("o_orderpriority").alias("title"),
        F.floor("o_totalprice").alias("workload"),
    )


def order_chapters(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as chapters: the title is the name of the part."""
    parts = read(spark, folder, "part").select("p_partkey", "p_name")
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("item_id"),
        F.col("l_linenumber").cast("long").alias("chapter_number"),
        F.col("p_name").alias("chapter_title"),
        F.col("l_returnflag").alias("attestation"),
    )


# Part names that count as generic headings.
GENERIC_PARTS = ["red widget", "Hot Bolt ", "large ring", "blue ring"]

ORDER_CHAPTERS_SQL = """
chapters AS (
  SELECT l_orderkey AS item_id, l_linenumber AS chapter_number, p_name AS chapter_title,
         l_returnflag AS attestation
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
GENERIC_SQL = "lower(chapter_title) IN ('red widget', 'hot bolt', 'large ring', 'blue ring')"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_wide(spark, folder, "documents").withColumn("lines", F.split("text", "\n"))


def document_items(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as items: the title is the first line, the group the source."""
    return _lines(spark, folder).select(
        F.col("lang").alias("scope"),
        F.col("source").alias("group_id"),
        F.col("doc_id").alias("item_id"),
        F.element_at("lines", 1).alias("title"),
        F.col("n_chars").alias("workload"),
    )


def document_chapters(spark: SparkSession, folder: str) -> DataFrame:
    """The later lines of a document as its chapters."""
    rows = _lines(spark, folder).select(
        F.col("doc_id").alias("item_id"), F.posexplode("lines").alias("chapter_number", "chapter_title")
    )
    return rows.where("chapter_number > 0")


# Lines that count as generic headings.
GENERIC_LINES = {"en": ["Introduction", "Summary"], "fr": ["résumé", "sommaire"]}

WHITESPACE_SQL = (
    r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip_sql(expression: str) -> str:
    return f"regexp_replace({expression}, '^{WHITESPACE_SQL}+|{WHITESPACE_SQL}+$', '', 'g')"


DOCUMENT_VIEWS_SQL = f"""
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
titled AS (SELECT doc_id, line AS title_text FROM lines WHERE pos = 1),
later AS (SELECT doc_id, pos, {strip_sql("line")} AS line FROM lines WHERE pos > 1),
joined AS (
  SELECT doc_id, string_agg(line, ' || ' ORDER BY pos) AS chap_titles_text
  FROM later
  WHERE length(line) >= 2
    AND lower(line) NOT IN ('introduction', 'summary', 'résumé', 'sommaire')
  GROUP BY doc_id),
views AS (
  SELECT d.doc_id AS item_id, d.source AS group_id, t.title_text,
         coalesce(j.chap_titles_text, '') AS chap_titles_text,
         CAST(d.n_chars AS VARCHAR) AS meta_text, d.lang
  FROM documents d JOIN titled t USING (doc_id) LEFT JOIN joined j USING (doc_id))
"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``(item_id, group_id, embedding)``."""
    return read_wide(spark, folder, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("label").alias("group_id"), "embedding"
    )
