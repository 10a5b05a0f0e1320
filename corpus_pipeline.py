"""The corpus pipeline: each stage works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import language_id, mixing, near_text, pieces, secrets
from catalith.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose text is in a known language."""
    return language_id.keep_known(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: five words, 0.8 or more."""
    return near_text.one_of_each(docs)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as ids of pieces; a document whose ids do not give its text again is an error."""
    found = pieces.encode(docs, pieces.load_vocabulary(), carry=("doc_id", "lang", "source"), check=True)
    wrong = F.raise_error(F.concat(F.lit("not decoded to its text: "), F.col("doc_id").cast("string")))
    ids = F.when(F.coalesce("round_trip", F.lit(True)), F.col("ids")).otherwise(wrong.cast("array<int>"))
    return found.select("doc_id", "lang", "source", ids.alias("ids"), "n_ids")


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("secrets", scan_secrets),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

# Language models, minwise trees and the hash that rounds the mixture have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
