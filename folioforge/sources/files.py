"""File sources: document discovery, page results, JSON lines, corrections, annotations, packages, dictionaries."""

from __future__ import annotations

import logging
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE_RESULT = (
    "width DOUBLE, height DOUBLE, page_index INT, page_count INT, parsing_res_list ARRAY<STRUCT<block_label STRING, block_content STRING, "
    "block_bbox ARRAY<DOUBLE>, block_id INT, block_order INT, group_id INT, block_polygon_points ARRAY<ARRAY<DOUBLE>>>>, _corrupt STRING"
)


def documents(spark: SparkSession, paths: list[str], glob: str = "*.pdf", unique_stems: bool = False) -> DataFrame:
    """path, stem, length of matching files, once each and in order of path; arguments that are files of another sort are skipped with a
    warning; two paths with one case-folded stem are an error if asked for."""
    other = [p for p in paths if "." in p.rsplit("/", 1)[-1] and not fnmatch(p.rsplit("/", 1)[-1].lower(), glob)]
    for p in other:
        logging.getLogger(__name__).warning("skipped, does not match %s: %s", glob, p)
    paths = [p for p in paths if p not in other]
    if not paths:
        return spark.createDataFrame([], "path string, length long, stem string").select("path", "length", "stem")
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(paths).select("path", "length").dropDuplicates(["path"])
    rows = rows.withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))
    if unique_stems:
        n = rows.groupBy(F.lower("stem").alias("low")).agg(F.count_distinct("path").alias("n"))
        rows = rows.join(n, F.lower("stem") == F.col("low")).withColumn("stem", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("two documents share the stem "), "stem"))).otherwise(F.col("stem"))).drop("low", "n")
    return rows.orderBy("path")


def page_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of all page results with their list position; corrupt files give no rows and no error."""
    pages = spark.read.schema(PAGE_RESULT).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("file", F.input_file_name())
    rows = pages.where("_corrupt IS NULL").select("file", "width", "height", F.posexplode("parsing_res_list").alias("source_index", "b"))
    return rows.select("file", "width", "height", "source_index", "b.*")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of a JSON-lines file with their line's order; malformed lines and other values are skipped."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name()).withColumn("seq", F.monotonically_increasing_id())
    parsed = lines.select("file", "seq", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("row"), F.try_parse_json("value").alias("v"))
    return parsed.where(F.col("v").isNotNull() & (F.schema_of_variant("v").startswith("OBJECT"))).select("file", "seq", "row.*")


def corrections(spark: SparkSession, path: str, row: str) -> DataFrame:
    """Rows of a corrections sidecar and the fingerprint of the very bytes they were read from."""
    files = spark.read.format("binaryFile").load(path)
    text = F.decode("content", "UTF-8")
    return files.select("path", F.sha2("content", 256).alias("fingerprint"), F.posexplode(F.from_json(text, f"corrections ARRAY<{row}>")["corrections"]).alias("seq", "c")).select("path", "fingerprint", "seq", "c.*")


def annotations(spark: SparkSession, path: str, row: str) -> DataFrame:
    """All annotation files' rows, tagged with their file."""
    files = spark.read.schema(f"annotations ARRAY<{row}>").option("multiLine", True).json(path)
    return files.select(F.input_file_name().alias("file"), F.explode("annotations").alias("a")).select("file", "a.*")


def packages(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Package folders; one without all required files is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    rows = files.groupBy(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("package")).agg(F.array_sort(F.collect_set(F.regexp_extract("path", "([^/]+)$", 1))).alias("files"))
    gone = F.array_except(F.array(*map(F.lit, required)), "files")
    return rows.withColumn("files", F.when(F.size(gone) > 0, F.raise_error(F.concat(F.lit("incomplete package "), "package"))).otherwise(F.col("files")))


def checked_packages(spark: SparkSession, path: str, required: list[str], id_file: str = "package.json") -> DataFrame:
    """packages() whose id, as id_file names it, is their folder's name and no other's; anything else is an error."""
    rows = packages(spark, path, required)
    ids = spark.read.schema("package_id STRING").option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", id_file).json(path)
    ids = ids.select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("_folder"), "package_id")
    n = F.count(F.lit(1)).over(Window.partitionBy("package_id"))
    rows = rows.withColumn("_folder", F.regexp_extract("package", "([^/]+)$", 1)).join(ids, "_folder", "left").withColumn("_n", n)
    bad = F.coalesce(F.col("package_id") != F.col("_folder"), F.lit(True)) | (F.col("_n") > 1)
    return rows.select("package", "files", F.when(bad, F.raise_error(F.concat(F.lit("package id does not fit "), "package"))).otherwise(F.col("package_id")).alias("package_id"))


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Lower-cased words of letters, one a line."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).where(F.col("word").rlike(r"^\p{L}+$")).distinct()


def citations(pages: DataFrame, key: str, html: str, prop: str) -> DataFrame:
    """Repeated <tr itemprop=...> rows of a page: number, dates, assignee, title as text without tags; a missing field is empty."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(rf'(?s)<tr[^>]*itemprop="{prop}"[^>]*>(.*?)</tr>'), F.lit(1))).alias("pos", "r"))
    field = lambda name: F.trim(F.regexp_replace(F.regexp_extract("r", rf'(?s)<(\w+)[^>]*itemprop="{name}"[^>]*>(.*?)</\1>', 2), "<[^>]*>", ""))
    return rows.select(key, "pos", field("publicationNumber").alias("number"), field("priorityDate").alias("priority"), field("publicationDate").alias("publication"), field("assigneeOriginal").alias("assignee"), field("title").alias("title"))
