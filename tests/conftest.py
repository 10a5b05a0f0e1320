from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


MASTER = "FLEET,FAMILY,CARD,TITLE,WORKLOAD\n"
CHAPTERS = "FLEET,FAMILY,CARD,CHAPTER_NUMBER,TITLE,ATTESTATION_TYPE\n"
ALIASES = {"FLEET": "scope", "FAMILY": "group_id", "CARD": "item_id"}
MASTER_ALIASES = {**ALIASES, "TITLE": "title", "WORKLOAD": "workload"}
CHAPTER_ALIASES = {
    **ALIASES,
    "CHAPTER_NUMBER": "chapter_number",
    "TITLE": "chapter_title",
    "ATTESTATION_TYPE": "attestation",
}


@pytest.fixture
def raw(tmp_path):
    """Write the two CSV tables and return their paths."""

    def write(master: str, chapters: str) -> tuple[str, str]:
        paths = tmp_path / "master.csv", tmp_path / "chapters.csv"
        paths[0].write_text(MASTER + master, encoding="utf-8")
        paths[1].write_text(CHAPTERS + chapters, encoding="utf-8")
        return str(paths[0]), str(paths[1])

    return write


@pytest.fixture
def load(spark, raw):
    from catalith.sources.readers import load_chapters, load_master

    def run(master: str, chapters: str, **options):
        m, c = raw(master, chapters)
        return (
            load_master(spark, m, aliases=MASTER_ALIASES, **options),
            load_chapters(spark, c, aliases=CHAPTER_ALIASES, **options),
        )

    return run


def rows(df, *columns):
    found = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in found.collect()), key=repr)
