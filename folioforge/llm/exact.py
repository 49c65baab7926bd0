"""Exact dedup by a tree merge of sorted digest runs.

Every partition sorts the digests of its rows into a run and collapses equal ones. Partitions then
exchange runs in binomial rounds: with partitions numbered in base FAN_IN, round k sends a record to the
partition whose k-th digit is the k-th digit of the record's digest, so after log_FAN_IN(P) rounds all
records of a digest have met and every partition holds one P-th of the digests. No partition ever
receives more than FAN_IN runs a round, each run has a digest once, and a merge streams over sorted
records with one record in memory, so a group of copies of any size costs at most one record a
partition. Each level keeps the smallest and the largest identifier, the row count, and a verifier (an
independent 64-bit hash over text and length); records merge only if digest and verifier both agree.

Between rounds a partition's runs are sorted again by Spark's own sort, which finds the runs in order, rather than merged by
a hand-written heap.

Defined results: a very long text is hashed whole; ties cannot arise, since the largest identifier stays; extra columns may have
any name; a null text counts as empty; of rows that repeat an identifier within a group just one
is kept; null identifiers are kept only where a group has no other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bin_values, free_name, map_text, materialize, widened

FAN_IN = 8
_NONE = -(1 << 63)
_RUN = "digest binary, verifier long, lo long, hi long, n long"


def with_digest(df: DataFrame, text_col: str, digest: str, verifier: str, drop_text: bool = False) -> DataFrame:
    """Adds SHA-256 and a verifier of the text after lower-casing A-Z."""
    fields = [f for f in df.schema.fields if not (drop_text and f.name == text_col)]
    schema = widened(fields, **{digest: "binary", verifier: "long"})
    names = [f.name for f in fields]

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        low = [(x or b"").lower() for x in bin_values(batch.column(text_col))]
        sums = pa.array([hashlib.sha256(x).digest() for x in low], pa.binary())
        ver = np.array([xxhash.xxh3_64_intdigest(x, len(x)) for x in low], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), sums, pa.array(ver)], [*names, digest, verifier])

    return map_text(df, text_col, f, schema)


def _collapse(batches):
    """Merge a sorted stream: equal (digest, verifier) records become one."""
    last = None

    def out(rows):
        key, ver, lo, hi, n = rows
        return pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in key], pa.binary()), pa.array(ver), pa.array(lo), pa.array(hi), pa.array(n)], ["digest", "verifier", "lo", "hi", "n"])

    for b in batches:
        if not b.num_rows:
            continue
        key = np.frombuffer(b"".join(bin_values(b.column("digest"))), dtype=np.uint8).reshape(-1, 32)
        rows = [key, *(b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("verifier", "lo", "hi", "n"))]
        if last is not None:
            rows = [np.concatenate(x) for x in zip(last, rows, strict=True)]
        key, ver = rows[0], rows[1]
        new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1) | (ver[1:] != ver[:-1])) + 1
        at = np.concatenate([[0], new])
        rows = [key[at], ver[at], np.minimum.reduceat(rows[2], at), np.maximum.reduceat(rows[3], at), np.add.reduceat(rows[4], at)]
        last = [x[-1:] for x in rows]
        if len(at) > 1:
            yield out([x[:-1] for x in rows])
    if last is not None:
        yield out(last)


def tree_merge(rows: DataFrame, id_col: str, digest: str, verifier: str, fan_in: int = FAN_IN) -> DataFrame:
    """One record per group: digest, verifier, lo, hi (smallest and largest identifier), n."""
    ident = F.col(id_col).cast("long")
    run = rows.select(
        F.col(digest).alias("digest"), F.col(verifier).alias("verifier"),
        F.coalesce(ident, F.lit((1 << 63) - 1)).alias("lo"), F.coalesce(ident, F.lit(_NONE)).alias("hi"), F.lit(1).cast("long").alias("n"),
    )
    want = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while fan_in**rounds < want:
        rounds += 1
    size = fan_in**rounds
    run = run.sortWithinPartitions("digest", "verifier").mapInArrow(_collapse, _RUN)
    head = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long")
    for k in range(rounds):
        unit = fan_in**k
        here = F.pmod(F.spark_partition_id().cast("long"), F.lit(size))
        digit = F.expr(f"{unit}L") * F.pmod((head / F.lit(unit)).cast("long"), F.lit(fan_in))
        mine = F.expr(f"{unit}L") * F.pmod((here / F.lit(unit)).cast("long"), F.lit(fan_in))
        run = run.withColumn("_to", (here - mine + digit).cast("int")).repartitionById(size, "_to").drop("_to")
        run = run.sortWithinPartitions("digest", "verifier").mapInArrow(_collapse, _RUN)
    gone = F.lit(_NONE)
    return run.select("digest", "verifier", F.when(F.col("hi") != gone, F.col("lo")).alias("lo"), F.when(F.col("hi") != gone, F.col("hi")).alias("hi"), "n")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row, dropped ones too."""
    rows = with_digest(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "text", "digest", "verifier", drop_text=True)
    rows = materialize(rows)
    root = tree_merge(rows, "doc_id", "digest", "verifier").select("digest", "verifier", F.col("hi" if keep == "largest" else "lo").alias("keep_id"), F.col("n").alias("group_size"))
    again = Window.partitionBy("digest", "doc_id", "verifier").orderBy("doc_id")
    rows = rows.withColumn("_again", F.row_number().over(again))
    out = rows.join(root, ["digest", "verifier"])
    return out.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_again") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The kept rows with all columns of df: texts move once, by identifier, which no group of copies can skew."""
    digest, verifier, again, i, d, v = free_name(df, "digest", "verifier", "again", "_id", "_d", "_v")
    root = tree_merge(with_digest(df.select(id_col, text_col), text_col, digest, verifier, drop_text=True), id_col, digest, verifier)
    root = root.select(F.col("hi" if keep == "largest" else "lo").alias(i), F.col("digest").alias(d), F.col("verifier").alias(v))
    rows = with_digest(df, text_col, digest, verifier)
    both = rows.join(root, F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.col(digest) == F.col(d)) & (F.col(verifier) == F.col(v)))
    first = Window.partitionBy(i, d, v).orderBy(F.lit(0))
    return both.withColumn(again, F.row_number().over(first)).where(F.col(again) == 1).select(*[F.col(f"`{c}`") for c in df.columns])


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256({_LOW}) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY {_LOW})
"""
