"""Five stages from raw documents to packed training sequences, each one of the operators of folioforge.llm.

Every stage reads all rows that its predecessor kept and returns the columns of documents, but for the last,
which returns where each piece of each document is packed. Stages accept what their operators accept: nulls in
any column, empty tables, repeated rows and extra columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.llm import exact, langid, packing, simhash, substring
from folioforge.llm.common import materialize


def language(spark, docs, sf_dir):
    """Documents whose language can be told; those without a letter go."""
    return langid.keep_identified(docs)


def exact_copies(spark, docs, sf_dir):
    """Of equal texts the row with the largest doc_id."""
    return exact.drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return simhash.keep_one_of_similar(docs)


def repeated_passages(spark, docs, sf_dir):
    """Texts without the passages of 50 words or more that a document with a smaller doc_id has; n_chars follows."""
    out = substring.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def packed(spark, docs, sf_dir):
    """Where each document's tokens go in sequences of 2048."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed),
]

#: Language profiles, SimHash and packing have no SQL form; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
