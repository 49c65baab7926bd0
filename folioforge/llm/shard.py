"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are shuffled by a seeded key inside each source and ranked there. The rank divided by the
source's size is a fractional rank; in the order of fractional ranks every stretch of rows holds the
sources in the proportions of the whole. Cutting that order into equal stretches gives shards that
match the mixture, with row counts at most one apart (law `rows`). The shuffle key is a hash of the identifier and
the text, so rows without an identifier, or with one that repeats, spread like any others.

No window ever spans a whole source or the whole table. A rank is a row number inside a small bucket
of the ordering key plus the number of rows in earlier buckets; the counts of buckets are a table of
at most CELLS rows a source, which is summed up bucket by bucket.

Defined results: very long texts only pass through two hashes; a null source is a source of its own; a null text has no bytes (size 8, CRC 0); rows
that repeat a doc_id are all kept and are ordered by their text's CRC and size; an empty table gives
an empty result; columns of the input other than the four named are carried if asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, unit_hash

SHARDS = 24
SEED = 17
#: Buckets of the shuffle key and of the fractional rank: windows run inside one bucket.
CELLS = 1 << 16
ROWS_A_BUCKET = 256


def _before(counts: DataFrame, keys: list[str], bucket: str, n: str, out: str) -> DataFrame:
    """Rows in earlier buckets of the same keys; two levels, so that no window sees all buckets."""
    group = F.expr(f"{bucket} div 256")
    fine = Window.partitionBy(*keys, "_hi").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_hi", group)
    high = counts.groupBy(*keys, "_hi").agg(F.sum(n).alias("_hn"))
    coarse = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_hi").rowsBetween(Window.unboundedPreceding, -1)
    high = high.withColumn("_hb", F.coalesce(F.sum("_hn").over(coarse), F.lit(0))).drop("_hn")
    fine_rows = counts.withColumn("_lb", F.coalesce(F.sum(n).over(fine), F.lit(0)))
    return fine_rows.join(high, [*keys, "_hi"]).select(*keys, bucket, (F.col("_lb") + F.col("_hb")).alias(out))


def interleave(df: DataFrame, n_shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the columns named in carry."""
    keep = list(carry)
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("_s"),
        *[F.col(c) for c in keep],
    )
    rows = rows.withColumn("_k", unit_hash(seed, F.col("doc_id"), F.col("text_crc32")))
    total = df.count()
    cells = max(1, min(CELLS, -(-total // ROWS_A_BUCKET)))
    rows = rows.withColumn("_b", F.expr(f"shiftright(_k, 44) * {cells}L div 65536L"))
    counts = rows.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.groupBy("_s").agg(F.sum("_n").alias("_ns"))
    offsets = _before(counts, ["_s"], "_b", "_n", "_o").join(sizes, "_s")
    inside = Window.partitionBy("_s", "_b").orderBy("_k", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_r", F.row_number().over(inside)).join(offsets, ["_s", "_b"])
    ranked = ranked.withColumn("_r", F.col("_o") + F.col("_r") - 1)
    # (2r + 1) / 2n as a bucket number: integers only, so that equal fractions stay equal.
    ranked = ranked.withColumn("_c", F.expr(f"(2 * _r + 1) * {cells}L div (2 * _ns)"))
    ranked = ranked.withColumn("_f", (2 * F.col("_r") + 1) / (2 * F.col("_ns")))
    ranked = ranked.drop("_b", "_o", "_r", "_ns")
    per = ranked.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    across = Window.partitionBy("_c").orderBy("_f", "_s", "_k", "doc_id", "text_crc32", "size")
    placed = ranked.withColumn("_p", F.row_number().over(across)).join(_before(per, [], "_c", "_n", "_o"), "_c")
    placed = placed.withColumn("_p", F.col("_o") + F.col("_p") - 1)
    n = max(total, 1)
    placed = placed.withColumn("shard", F.expr(f"((_p + 1) * {n_shards}L - 1) div {n}L").cast("int"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("_p") - F.expr(f"shard * {n}L div {n_shards}L")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *keep,
    )


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    return interleave(spark.read.parquet(f"{sf_dir}/documents.parquet"))
