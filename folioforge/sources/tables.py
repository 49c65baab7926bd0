"""Readers of the driver's tables and the inputs derived from them (words with geometry, damaged copies, intervals, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def damaged(text: Column, doc_id: Column) -> Column:
    """A deterministic damaged copy: letters lost, a tail lost, a beginning repeated, or nothing."""
    kind = doc_id % 7
    return (
        F.when(kind == 0, F.regexp_replace(text, "e", ""))
        .when(kind == 1, F.substring(text, F.lit(1), F.floor(F.length(text) * 4 / 5).cast("int")))
        .when(kind == 2, F.concat(text, F.substring(text, 1, 40)))
        .otherwise(text)
    )


#: The same derivation for the other engine.
DAMAGED = """CASE doc_id % 7 WHEN 0 THEN replace(text, 'e', '') WHEN 1 THEN substr(text, 1, CAST(floor(length(text) * 4 / 5) AS INTEGER))
 WHEN 2 THEN text || substr(text, 1, 40) ELSE text END"""


#: Fixed value: bytes of files that one part of a table dealt by document holds.
PART = 1 << 20


def by_document(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents dealt by their key, before they become many rows: pages, lines and joins of a document's rows then need no further
    shuffle. The number of parts follows the size of the files."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return docs.repartition(max(1, min(-(-size // PART), 20000)), key)


def words(docs: DataFrame) -> DataFrame:
    """doc_id, ix, word, page, line_no, x0, x1, y0, y1: tokens laid out 12 a line, 50 lines a page of 612 x 792."""
    out = by_document(docs.select("doc_id", "text")).select("doc_id", F.posexplode(F.split(F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " ")), " ")).alias("ix", "word")).where("word <> ''")
    return out.select(
        "doc_id", "ix", "word", F.expr("ix div 600").cast("int").alias("page"), F.expr("(ix % 600) div 12").cast("int").alias("line_no"),
        (72.0 + (F.col("ix") % 12) * 40).alias("x0"), (102.0 + (F.col("ix") % 12) * 40).alias("x1"),
        (60.0 + F.expr("(ix % 600) div 12") * 14).alias("y0"), (68.0 + F.expr("(ix % 600) div 12") * 14).alias("y1"),
    )


WORDS = r"""words AS (SELECT doc_id, ix, word, CAST(ix // 600 AS INTEGER) AS page, CAST((ix % 600) // 12 AS INTEGER) AS line_no,
  72.0 + (ix % 12) * 40 AS x0, 102.0 + (ix % 12) * 40 AS x1, 60.0 + ((ix % 600) // 12) * 14 AS y0, 68.0 + ((ix % 600) // 12) * 14 AS y1
 FROM (SELECT doc_id, unnest(range(len(ws))) AS ix, unnest(ws) AS word FROM (SELECT doc_id, string_split(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')), ' ') AS ws FROM documents)) WHERE word <> '')"""


#: The other engine's edit distance counts bytes; the tables' letters outside ASCII become control characters, one for one.
_WIDE = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü²∑§\ue000"
_NARROW = "".join(map(chr, [*range(1, 9), *range(14, 32)]))[: len(_WIDE)]


def edits(a: str, b: str) -> str:
    """SQL of the edit distance by code point."""
    return f"levenshtein(translate({a}, '{_WIDE}', '{_NARROW}'), translate({b}, '{_WIDE}', '{_NARROW}'))"
