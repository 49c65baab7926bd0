"""Sinks: versioned pages, JSON lines with a bounded summary, Markdown reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.ordered import bounded_counts


def write_pages(df: DataFrame, path: str, key: str) -> None:
    """Replaces only the documents that df holds; readers see a document's old or new pages, never a mix."""
    df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(key).parquet(path)


def write_findings(df: DataFrame, path: str, kind: str, limit: int = 50) -> DataFrame:
    """Appends all findings as JSON lines and returns the bounded summary by kind."""
    df.write.mode("append").json(path)
    return bounded_counts(df, [], kind, limit)


def write_report(df: DataFrame, path: str, title: str) -> None:
    """A Markdown table of the rows, in the order of their first column; part files follow each other."""
    first = df.columns[0]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"\|", r"\\|"), F.lit("")) for c in df.columns]), F.lit(" |"))
    head = f"# {title}\n\n| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    lines = df.select(F.lit(1).alias("_part"), F.col(first).alias("_key"), row.alias("value"))
    top = df.sparkSession.range(1).select(F.lit(0).alias("_part"), F.lit(None).cast(df.schema[first].dataType).alias("_key"), F.lit(head).alias("value"))
    top.unionByName(lines).orderBy("_part", "_key", "value").select("value").write.mode("overwrite").text(path)


def _sealed(columns: list[str]):
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def store_pages(df: DataFrame, path: str) -> int:
    """A new version of page records (doc, page, cache_key, markdown, ...), each with the hash of its Markdown and of itself, and makes it
    the current one. Earlier versions stay: they are the snapshots to go back to."""
    spark = df.sparkSession
    version = max(_versions(spark, path), default=-1) + 1
    rows = df.withColumn("page_md_sha256", F.sha2(F.coalesce("markdown", F.lit("")), 256))
    rows.withColumn("record_sha256", _sealed(rows.columns)).write.mode("overwrite").parquet(f"{path}/records/version={version}")
    _point(spark, path, version)
    return version


def _log(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(step, version) of a store, in order; a row a write or roll-back. No log, no versions."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return []
    return [(r["step"], r["version"]) for r in spark.read.schema("step long, version long").json(f"{path}/log").orderBy("step").collect()]


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [v for _, v in _log(spark, path)]


def _point(spark: SparkSession, path: str, version: int) -> None:
    spark.createDataFrame([(len(_log(spark, path)), version)], "step long, version long").coalesce(1).write.mode("append").json(f"{path}/log")


def roll_back(spark: SparkSession, path: str, version: int) -> None:
    """Makes an earlier version the current one."""
    if version not in _versions(spark, path):
        raise ValueError(f"no version {version}")
    _point(spark, path, version)


def read_stored_pages(spark: SparkSession, path: str, expected: DataFrame | None = None) -> DataFrame:
    """Records of the current version that are whole (their own hashes hold) and, with expected (doc, page, cache_key), fresh. Stale and
    damaged ones are left out."""
    version = _versions(spark, path)[-1]
    rows = spark.read.parquet(f"{path}/records/version={version}")
    own = [c for c in rows.columns if c != "record_sha256"]
    rows = rows.where((F.col("record_sha256") == _sealed(own)) & (F.col("page_md_sha256") == F.sha2(F.coalesce("markdown", F.lit("")), 256)))
    return rows if expected is None else rows.join(expected, ["doc", "page", "cache_key"], "left_semi")
