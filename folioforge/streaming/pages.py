"""Incremental processing: a file stream of page tasks run to the end of what is there, with poison pages set aside.

A checkpoint makes each input file count once, whatever restarts; attempts are counted by page, and a page that
failed MAX_ATTEMPTS times is no longer tried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ATTEMPTS = 2


def to_do(pages: DataFrame, done: DataFrame, failures: DataFrame, keys: list[str], most: int = MAX_ATTEMPTS) -> DataFrame:
    """Expected pages that are not done and not poisoned."""
    poison = failures.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= most)
    return pages.join(done.select(*keys), keys, "left_anti").join(poison.select(*keys), keys, "left_anti")


def run_until_done(run: Callable[[], str], most: int = 50) -> tuple[str, int]:
    """Runs again after each failure, up to `most` restarts: the last status (OK and SUSPECT end it) and how many restarts it took."""
    for restarts in range(most + 1):
        status = run()
        if status in ("OK", "SUSPECT"):
            return status, restarts
    return "FAILED", most


def finished(manifests: DataFrame, wanted: DataFrame, done: DataFrame, poisoned: DataFrame) -> DataFrame:
    """Documents (doc, fingerprint, dpi, page_count) that a resumed run may skip: their manifest has the wanted fingerprint and
    resolution, and every page is done or poisoned. A page that failed for the moment is still to do."""
    same = wanted.join(manifests.select("doc", F.col("fingerprint").alias("_f"), F.col("dpi").alias("_d"), "page_count"), "doc").where(F.col("fingerprint").eqNullSafe(F.col("_f")) & F.col("dpi").eqNullSafe(F.col("_d")))
    closed = done.select("doc", "page").union(poisoned.select("doc", "page")).distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("_n"))
    return same.join(closed, "doc", "left").where(F.coalesce("_n", F.lit(0)) >= F.col("page_count")).select("doc")


def run_available(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]) -> None:
    """Applies step to all files not seen before and appends the result; returns when none are left."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = step(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event-time window, closed by a watermark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
