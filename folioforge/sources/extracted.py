"""Words that an extractor wrote, one JSON object a page: the engine's own reading, a second one, page texts and fonts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WORD = "STRUCT<x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, text STRING, block_no INT, line_no INT, word_no INT>"
EXTRACTED = (
    f"doc STRING, page INT, width DOUBLE, height DOUBLE, text STRING, words ARRAY<{_WORD}>, baseline ARRAY<{_WORD}>, "
    "fonts ARRAY<STRUCT<xref INT, name STRING, basefont STRING, type STRING, encoding STRING, has_tounicode BOOLEAN>>, _corrupt STRING"
)
READINGS = {"engine": "words", "baseline": "baseline"}


def _pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXTRACTED).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).where("_corrupt IS NULL AND doc IS NOT NULL")


def page_words(spark: SparkSession, path: str, extractor: str = "engine") -> DataFrame:
    """doc, page, ix, word, x0, y0, x1, y1, block_no, line_no, word_no, extractor of the words that are not blank, in the order they were
    read; extractor chooses the reading. Malformed lines are skipped."""
    rows = _pages(spark, path).select("doc", "page", F.posexplode(READINGS[extractor]).alias("ix", "w"))
    return rows.where(F.col("w.text").rlike(r"\S")).select("doc", "page", "ix", F.col("w.text").alias("word"), "w.x0", "w.y0", "w.x1", "w.y1", "w.block_no", "w.line_no", "w.word_no", F.lit(extractor).alias("extractor"))


def page_sources(spark: SparkSession, path: str) -> DataFrame:
    """doc, page, width, height, text of every page."""
    return _pages(spark, path).select("doc", "page", "width", "height", F.coalesce("text", F.lit("")).alias("text"))


def page_fonts(spark: SparkSession, path: str) -> DataFrame:
    """Fonts of every page; whether one has a way back to text is null where the extractor could not tell."""
    return _pages(spark, path).select("doc", "page", F.inline("fonts"))
