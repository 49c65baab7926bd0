"""Page and block audit: geometry checks, asset names, lookups with fallback, render errors, annotations, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.coverage import coverage, repetition
from folioforge.operators.geometry import RUNNING_HEADER
from folioforge.sources.tables import DAMAGED, damaged, table

#: Labels whose blocks are saved as images.
VISUAL = ("image", "chart", "header_image", "footer_image", "seal")


def valid_bbox(box: Column) -> Column:
    """Four finite numbers, none negative, with an extent both ways."""
    fine = F.forall(box, lambda x: x.isNotNull() & ~F.isnan(x) & (x >= 0) & (x < float("inf")))
    return F.coalesce((F.size(box) == 4) & fine & (F.get(box, F.lit(2)) > F.get(box, F.lit(0))) & (F.get(box, F.lit(3)) > F.get(box, F.lit(1))), F.lit(False))


def unscorable_reasons(rotation: Column, cropbox_ok: Column, ocr_width: Column, ocr_height: Column, pdf_width: Column, pdf_height: Column) -> Column:
    """Comma-joined reasons why a page cannot be scored; empty if it can. Sizes must be positive and finite."""
    bad = lambda c: ~F.coalesce((c > 0) & (c < float("inf")), F.lit(False))
    return F.concat_ws(",", F.when(rotation != 0, "rotation"), F.when(~F.coalesce(cropbox_ok, F.lit(False)), "cropbox"), F.when(bad(ocr_width) | bad(ocr_height), "ocr_dims"), F.when(bad(pdf_width) | bad(pdf_height), "pdf_dims"))


def is_visual(label: Column) -> Column:
    return F.coalesce(label.isin(*VISUAL), F.lit(False))


def crop_name(label: Column, order: Column, page: Column, block: Column) -> Column:
    """File name of a visual block without reading order, else null."""
    return F.when(label.isin(*VISUAL) & order.isNull(), F.format_string("page_%04d_block_%s.png", page.cast("int"), block.cast("string")))


def find_block(refs: DataFrame, blocks: DataFrame, page: list[str]) -> DataFrame:
    """The block of a reference by its id, else by its list position, and which of the two it was."""
    by_id = blocks.select(*page, F.col("block_id").cast("long").alias("_i"), F.col("source_index").alias("a"))
    by_place = blocks.select(*page, F.col("source_index").alias("_p"))
    rows = refs.withColumn("_i", F.col("ref").try_cast("long")).join(by_id, [*page, "_i"], "left")
    rows = rows.withColumn("_p", F.col("position")).join(by_place.withColumn("b", F.col("_p")), [*page, "_p"], "left")
    return rows.select(*page, "ref", F.coalesce("a", "b").alias("source_index"), (F.col("a").isNull() & F.col("b").isNotNull()).alias("positional"))


def errors_to_blocks(errors: DataFrame, blocks: DataFrame, page: list[str]) -> DataFrame:
    """The formula blocks of render errors (error_id, block_ids, head): page, error_id, block_id, by.

    An error that names blocks has those that exist. Another has the first block, in list order, whose text begins with the
    error's head or begins it, outer dollars and white space aside. Errors without a block give no row.
    """
    bare = lambda c: F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"^\$\$|\$\$$", ""), r"\s+", "")
    packed = blocks.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("source_index", "block_id", bare(F.col("content")).alias("c")))).alias("_b"))
    rows = errors.join(packed, page).withColumn("_h", bare(F.col("head")))
    named = F.size(F.coalesce("block_ids", F.array().cast("array<int>"))) > 0
    by_id = F.filter("_b", lambda b: F.array_contains("block_ids", b["block_id"]))
    by_head = F.slice(F.filter("_b", lambda b: (F.col("_h") != "") & (b["c"] != "") & (b["c"].startswith(F.col("_h")) | F.col("_h").startswith(b["c"]))), 1, 1)
    hit = F.explode(F.when(named, by_id).otherwise(by_head))
    return rows.select(*page, "error_id", F.when(named, "id").otherwise("prefix").alias("by"), hit.alias("b")).select(*page, "error_id", "b.block_id", "by")


def attribute_errors(errors: DataFrame, blocks: DataFrame, page: list[str]) -> DataFrame:
    """The one block of a document whose text holds an error's head; none or several are told apart."""
    rows = errors.join(blocks.select(*page, "block_id", F.col("content").alias("_c")), page, "left")
    hit = (F.trim(F.col("head")) != "") & F.contains("_c", F.trim(F.col("head")))
    found = rows.groupBy(*page, "error_id").agg(F.count_if(hit).alias("n"), F.min(F.when(hit, F.col("block_id"))).alias("b"))
    return found.select(*page, "error_id", F.when(F.col("n") == 1, F.col("b")).alias("block_id"), F.when(F.col("n") == 1, "matched").when(F.col("n") > 1, "ambiguous").otherwise("unmatched").alias("outcome"))


def best_marker(items: DataFrame, markers: DataFrame, key: str) -> DataFrame:
    """The marker whose tokens overlap most with a document's leftover tokens (as bags); the first marker wins ties."""
    m = markers.groupBy("marker", "token").agg(F.count(F.lit(1)).alias("m"))
    n = items.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))
    per = n.join(m, "token").groupBy(key, "marker").agg(F.sum(F.least("n", "m")).alias("overlap"))
    w = Window.partitionBy(key).orderBy(F.desc("overlap"), "marker")
    return per.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


#: A reference to a figure, and lines that are a leaked header.
FIGURE = r"(?i)\bFIG(?:URE|S)?\s*\.?\s*([0-9]+[A-Z]?)"
HEADER_CHARS = 45


def figure_lint(df: DataFrame, key: str, text: str, available: str) -> DataFrame:
    """Figures that a text refers to and that are not there, upper-cased, in order of first mention."""
    seen = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(FIGURE), F.lit(1)), lambda x: F.upper(x)))
    return df.select(key, F.array_except(seen, F.transform(available, lambda x: F.upper(x))).alias("missing"))


def text_lint(text: Column, claims: Column, available: Column) -> Column:
    """struct(leaked, lone, claims_ok, figures): distinct short lines that look like a running header and begin in no lower case; how
    many lines are nothing but a multiple of five; whether claims are numbered 1 to N; figures mentioned and not there."""
    lines = F.transform(F.split(F.regexp_replace(text, r"!\[[^\]]*\]\([^)]*\)", ""), "\n"), lambda x: F.trim(F.regexp_replace(F.trim(x), r"^[*#>]+|[*#>]+$", "")))
    leaked = F.array_sort(F.array_distinct(F.filter(lines, lambda x: (x != "") & (F.length(x) <= HEADER_CHARS) & ~x.rlike(r"^\p{Ll}") & x.rlike(RUNNING_HEADER))))
    lone = F.size(F.filter(F.split(text, "\n"), lambda x: F.trim(x).rlike("^[0-9]?[05]$")))
    numbers = F.transform(F.regexp_extract_all(F.coalesce(claims, F.lit("")), F.lit(r"(?m)^(\d{1,3})\.\s"), F.lit(1)), lambda x: x.cast("int"))
    in_order = (F.size(numbers) == 0) | (numbers == F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1))))
    seen = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(FIGURE), F.lit(1)), lambda x: F.upper(x)))
    figures = F.when(F.size(available) > 0, F.array_except(seen, F.transform(available, lambda x: F.upper(x)))).otherwise(F.array().cast("array<string>"))
    return F.struct(leaked.alias("leaked"), lone.alias("lone"), in_order.alias("claims_ok"), figures.alias("figures"))


def is_suspect(missing_ratio: Column, lint: Column, threshold: float = 0.005) -> Column:
    """A document is suspect with too much missing or any structural issue; figures that are missing never count."""
    return (missing_ratio > threshold) | (F.size(lint["leaked"]) > 0) | (lint["lone"] > 0) | ~lint["claims_ok"]


#: Fixed value: issues that make no page suspect.
HARMLESS = ("furniture_prose_noise",)


def page_reports(pages: DataFrame, failed: DataFrame, blocks: DataFrame, prose: DataFrame, issues: DataFrame, keys: list[str]) -> DataFrame:
    """One row an expected page (keys, has_result): status, scored, codes.

    A page without a result is page_failed where failed names it and page_incomplete elsewhere, both UNSCORABLE; a page
    without blocks is OK; else it has the sorted union of its prose, formula and table issues (keys, code), is UNSCORABLE
    where its prose (keys, status) is, SUSPECT with any issue that is not harmless, and OK without.
    """
    tag = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    codes = issues.groupBy(*keys).agg(F.array_sort(F.collect_set("code")).alias("_codes"))
    rows = pages.join(tag(failed, "_f"), keys, "left").join(tag(blocks, "_b"), keys, "left").join(codes, keys, "left").join(prose.select(*keys, F.col("status").alias("_p")), keys, "left")
    gone, none = ~F.col("has_result"), F.array().cast("array<string>")
    own = F.when(gone & F.col("_f"), F.array(F.lit("page_failed"))).when(gone, F.array(F.lit("page_incomplete"))).when(F.col("_b").isNull(), none).otherwise(F.coalesce("_codes", none))
    status = F.when(gone, "UNSCORABLE").when(F.col("_b").isNull(), "OK").when(F.col("_p") == "UNSCORABLE", "UNSCORABLE").when(F.size(F.array_except(own, F.array(*map(F.lit, HARMLESS)))) > 0, "SUSPECT").otherwise("OK")
    return rows.select(*keys, status.alias("status"), own.alias("codes")).withColumn("scored", F.col("status") != "UNSCORABLE")


def document_reports(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """Status of documents from their pages' (status, scored, codes): UNSCORABLE without a scored page, SUSPECT with a suspect or an
    unscored one, else OK; the suspect pages and the counts of issue codes."""
    out = pages.groupBy(doc).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("scored").alias("scored_pages"), F.array_sort(F.collect_list(F.when(F.col("status") == "SUSPECT", F.col(page)))).alias("suspect_pages"),
        F.flatten(F.collect_list("codes")).alias("_c"))
    status = F.when(F.col("scored_pages") == 0, "UNSCORABLE").when((F.size("suspect_pages") > 0) | (F.col("scored_pages") < F.col("pages")), "SUSPECT").otherwise("OK")
    counts = F.map_from_entries(F.transform(F.array_sort(F.array_distinct("_c")), lambda c: F.struct(c, F.size(F.filter("_c", lambda x: x == c)))))
    return out.select(doc, status.alias("status"), "pages", "scored_pages", "suspect_pages", counts.alias("issue_counts"))


#: Codes of a report that cannot be used, in order of precedence.
REPORT_CODES = ("audit_report_missing", "audit_report_corrupt", "audit_report_stale")


def report_code(present: Column, readable: Column, version: Column, want_version: Column, fingerprint: Column, want_fingerprint: Column, dpi: Column, want_dpi: Column) -> Column:
    """Why a written report cannot be used, or null: it is missing, cannot be read, or was made of other inputs."""
    stale = ~(version.eqNullSafe(want_version) & fingerprint.eqNullSafe(want_fingerprint) & dpi.eqNullSafe(want_dpi))
    return F.when(~present, REPORT_CODES[0]).when(~readable, REPORT_CODES[1]).when(stale, REPORT_CODES[2])


def degeneration(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """The largest repetition score of a document's pages (repetition, codes), and the pages flagged for it."""
    hit = F.array_contains("codes", "ocr_degeneration")
    return pages.groupBy(doc).agg(F.coalesce(F.max("repetition"), F.lit(0.0)).alias("max_repetition"), F.array_sort(F.collect_list(F.when(hit, F.col(page)))).alias("flagged_pages"))


def geometry_status(spark, sf_dir):
    """Boxes and page sizes out of line items' amounts; rotation, crop boxes and missing sizes by their flags and tax."""
    q, d, t, p = F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100, F.col("l_extendedprice")
    box = F.when(F.col("l_linenumber") == 6, F.array(q, d, q)).otherwise(F.array(q - 2, d, F.when(F.col("l_returnflag") == "R", t * 7).otherwise(p), F.when(t == 0, F.lit(None)).when(t == 1, F.lit(float("nan"))).otherwise(t * 2)))
    reasons = unscorable_reasons(F.when(F.col("l_returnflag") == "A", 90).otherwise(0), F.when(F.col("l_linenumber") != 5, F.col("l_linestatus") == "O"), F.when(d != 3, q), F.when(t == 2, F.lit(float("inf"))).otherwise(t), d, p)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", valid_bbox(box).alias("valid"), reasons.alias("reasons"))


def crop_names(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, ["image", "text", "chart", "seal", "header_image", "table"])), (F.col("l_suppkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", crop_name(label, F.when(F.col("l_returnflag") == "N", 1), F.col("l_linenumber"), F.col("l_partkey")).alias("file"))


def block_lookup(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    blocks = turns.select("conv_id", (F.col("turn") * 10).alias("block_id"), "turn").withColumnRenamed("turn", "source_index")
    refs = turns.select("conv_id", F.when(F.col("turn") % 3 == 0, (F.col("turn") * 10).cast("string")).otherwise(F.concat(F.lit("x"), "turn")).alias("ref"), (F.col("turn") * 2).alias("position"))
    return find_block(refs, blocks, ["conv_id"])


def render_error_blocks(spark, sf_dir):
    """Errors of turns: some name blocks, others have the head of a text, more than all of it, or no text that exists."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("source_index"), F.col("turn").cast("int").alias("block_id"), F.concat(F.lit("$$ "), "text", F.lit(" $$")).alias("content"))
    k = F.col("block_id") % 5
    head = F.when(k == 1, "no such text").when(k == 2, F.concat("content", F.lit(" and more"))).when(k == 3, "").otherwise(F.substring("content", 1, 30))
    ids = F.when(k == 4, F.array(F.col("block_id") - 1, F.col("block_id") + 1, F.lit(99999)))
    return errors_to_blocks(turns.select("conv_id", F.col("block_id").alias("error_id"), ids.alias("block_ids"), head.alias("head")), turns, ["conv_id"])


def render_error_sources(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("block_id"), F.col("text").alias("content"))
    head = F.when(F.col("block_id") % 4 == 1, "no such text").when(F.col("block_id") % 4 == 3, F.substring("content", 1, 2)).otherwise(F.substring("content", 1, 30))
    return attribute_errors(turns.select("conv_id", F.col("block_id").alias("error_id"), head.alias("head")), turns, ["conv_id"])


def marker_choice(spark, sf_dir):
    items = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("token"))
    return best_marker(items, spark.createDataFrame([("a", "click"), ("a", "click"), ("a", "view"), ("b", "view"), ("b", "view"), ("b", "purchase")], "marker string, token string"), "user_id")


def figure_references(spark, sf_dir):
    """Whole texts with figures in place of some words, against those that are there."""
    text = F.replace(F.replace("text", F.lit(" the "), F.lit(" FIG. 7 ")), F.lit(" der "), F.concat(F.lit(" Figures FIGURE"), F.col("doc_id") % 5, F.lit("b, configure 4 ")))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), F.array(F.lit("3B"), F.lit("1")).alias("have"))
    return figure_lint(docs, "doc_id", "text", "have").select("doc_id", F.array_join("missing", ",").alias("missing"))


def document_verdicts(spark, sf_dir):
    """Lint of whole texts and the suspect rule over their coverage by damaged copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", damaged(F.col("text"), F.col("doc_id")).alias("output"))
    k = F.col("doc_id") % 8
    output = F.concat("output", F.when(k == 3, "\n# US 10,155,111 B2\n").when(k == 4, "\n35\n 5 \n7\n").when(k == 5, "\nsee FIG. 9\n").when(k == 6, "\n![US 1,2 B1](x)\nin U.S. Patent law\n").otherwise(""))
    claims = F.when(F.col("doc_id") % 9 == 4, "1. A\n\n3. B").when(F.col("doc_id") % 9 < 3, "1. A\n2. B")
    rows = docs.join(coverage(docs, "doc_id", F.col("text"), F.col("output")).select("doc_id", "missing_ratio"), "doc_id")
    rows = rows.select("doc_id", "missing_ratio", text_lint(output, claims, F.array(F.lit("1"))).alias("lint"))
    return rows.select("doc_id", F.array_join("lint.leaked", "|").alias("leaked"), "lint.lone", "lint.claims_ok", F.array_join("lint.figures", ",").alias("figures"), is_suspect(F.col("missing_ratio"), F.col("lint")).alias("suspect"))


def _report_pages(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    pages = turns.select("conv_id", "turn", (F.col("n") % 6 != 5).alias("has_result"))
    code = lambda c, cond: turns.where(cond).select("conv_id", "turn", F.lit(c).alias("code"))
    issues = code("missing_prose", "n % 7 = 0").unionByName(code("furniture_prose_noise", "n % 3 = 0")).unionByName(code("sign_flip", "n % 11 = 4")).unionByName(code("sign_flip", "n % 11 = 4")).unionByName(code("ocr_degeneration", "n % 13 = 1"))
    prose = turns.select("conv_id", "turn", F.when(F.col("n") % 10 == 2, "UNSCORABLE").otherwise("OK").alias("status"))
    return page_reports(pages, turns.where("n % 4 = 1"), turns.where("n % 8 <> 2"), prose, issues, ["conv_id", "turn"])


def page_report(spark, sf_dir):
    return _report_pages(spark, sf_dir).select("conv_id", "turn", "status", "scored", F.array_join("codes", ",").alias("codes"))


def document_report(spark, sf_dir):
    rows = document_reports(_report_pages(spark, sf_dir), "conv_id", "turn")
    listed = F.array_join(F.transform(F.map_entries("issue_counts"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return rows.select("conv_id", "status", "pages", "scored_pages", F.array_join(F.transform("suspect_pages", lambda x: x.cast("string")), ",").alias("suspect_pages"), listed.alias("issues"))


def degeneration_report(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", repetition(F.col("text")).alias("repetition"))
    rows = turns.withColumn("codes", F.when(F.col("repetition") > 0.2, F.array(F.lit("ocr_degeneration"))).otherwise(F.array(F.lit("x"))))
    return degeneration(rows, "conv_id", "turn").select("conv_id", "max_repetition", F.array_join(F.transform("flagged_pages", lambda x: x.cast("string")), ",").alias("flagged"))


def report_codes(spark, sf_dir):
    o = F.col("o_orderkey")
    code = report_code(o % 7 != 0, o % 5 != 0, o % 3, F.lit(1), F.col("o_totalprice") > 100000, F.lit(True), F.when(o % 11 != 0, 150), F.lit(150))
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"))


QUERIES = {f.__name__: f for f in (geometry_status, crop_names, block_lookup, render_error_blocks, render_error_sources, marker_choice, figure_references, document_verdicts, page_report, document_report, degeneration_report, report_codes)}
_REPORT = """t AS (SELECT conv_id, turn, length(text) AS n FROM conversations),
 r AS (SELECT conv_id, turn, CASE WHEN n % 6 = 5 THEN 'UNSCORABLE' WHEN n % 8 = 2 THEN 'OK' WHEN n % 10 = 2 THEN 'UNSCORABLE' WHEN n % 7 = 0 OR n % 11 = 4 OR n % 13 = 1 THEN 'SUSPECT' ELSE 'OK' END AS status,
  CASE WHEN n % 6 = 5 AND n % 4 = 1 THEN ['page_failed'] WHEN n % 6 = 5 THEN ['page_incomplete'] WHEN n % 8 = 2 THEN [] ELSE list_filter([CASE WHEN n % 3 = 0 THEN 'furniture_prose_noise' END, CASE WHEN n % 7 = 0 THEN 'missing_prose' END, CASE WHEN n % 13 = 1 THEN 'ocr_degeneration' END, CASE WHEN n % 11 = 4 THEN 'sign_flip' END], lambda x: x IS NOT NULL) END AS codes FROM t)"""
ORACLE = {
    "geometry_status": """WITH l AS (SELECT *, l_quantity AS q, l_discount * 100 AS d, l_tax * 100 AS t, l_extendedprice AS p FROM lineitem),
 b AS (SELECT *, q - 2 AS x0, d AS y0, CASE WHEN l_returnflag = 'R' THEN t * 7 ELSE p END AS x1, CASE WHEN t = 0 OR t = 1 THEN NULL ELSE t * 2 END AS y1 FROM l)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber <> 6 AND coalesce(x0 >= 0 AND y0 >= 0 AND x1 >= 0 AND y1 >= 0 AND x1 > x0 AND y1 > y0, false) AS valid,
  array_to_string(list_filter([CASE WHEN l_returnflag = 'A' THEN 'rotation' END, CASE WHEN l_linenumber = 5 OR l_linestatus <> 'O' THEN 'cropbox' END, CASE WHEN d = 3 OR NOT q > 0 OR t = 2 OR NOT t > 0 THEN 'ocr_dims' END, CASE WHEN NOT d > 0 OR NOT p > 0 THEN 'pdf_dims' END], lambda x: x IS NOT NULL), ',') AS reasons FROM b""",
    "crop_names": "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_suppkey % 6 NOT IN (1, 5) AND l_returnflag <> 'N' THEN printf('page_%04d_block_%d.png', l_linenumber, l_partkey) END AS file FROM lineitem",
    "block_lookup": """WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN CAST(turn * 10 AS VARCHAR) ELSE 'x' || turn END AS ref FROM conversations)
 SELECT r.conv_id, ref, CASE WHEN r.turn % 3 = 0 THEN r.turn ELSE p.turn END AS source_index, r.turn % 3 <> 0 AND p.turn IS NOT NULL AS positional FROM r LEFT JOIN conversations p ON p.conv_id = r.conv_id AND p.turn = r.turn * 2""",
    "render_error_blocks": r"""WITH b AS (SELECT conv_id, turn, regexp_replace(text, '\s+', '', 'g') AS c FROM conversations),
 e AS (SELECT conv_id, turn, CASE turn % 5 WHEN 1 THEN 'nosuchtext' WHEN 2 THEN c || '$$andmore' WHEN 3 THEN '' WHEN 4 THEN '' ELSE regexp_replace(substr('$$ ' || text || ' $$', 1, 30)[3:], '\s+', '', 'g') END AS h0 FROM b JOIN conversations USING (conv_id, turn)),
 f AS (SELECT *, regexp_replace(h0, '\$\$$', '') AS h FROM e)
 SELECT f.conv_id, CAST(f.turn AS INTEGER) AS error_id, CAST(min(b.turn) AS INTEGER) AS block_id, 'prefix' AS "by" FROM f JOIN b ON b.conv_id = f.conv_id AND b.c <> '' AND f.h <> '' AND (starts_with(b.c, f.h) OR starts_with(f.h, b.c)) WHERE f.turn % 5 <> 4 GROUP BY f.conv_id, f.turn
 UNION ALL SELECT f.conv_id, CAST(f.turn AS INTEGER), CAST(b.turn AS INTEGER), 'id' FROM f JOIN b ON b.conv_id = f.conv_id AND b.turn IN (f.turn - 1, f.turn + 1) WHERE f.turn % 5 = 4""",
    "render_error_sources": r"""WITH e AS (SELECT conv_id, turn, trim(CASE turn % 4 WHEN 1 THEN 'no such text' WHEN 3 THEN substr(text, 1, 2) ELSE substr(text, 1, 30) END, ' ') AS h FROM conversations),
 g AS (SELECT e.conv_id, e.turn AS error_id, count(*) FILTER (h <> '' AND contains(b.text, h)) AS n, min(b.turn) FILTER (h <> '' AND contains(b.text, h)) AS b FROM e JOIN conversations b ON b.conv_id = e.conv_id GROUP BY ALL)
 SELECT conv_id, error_id, CASE WHEN n = 1 THEN b END AS block_id, CASE WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS outcome FROM g""",
    "marker_choice": """WITH m(marker, token, m) AS (VALUES ('a', 'click', 2), ('a', 'view', 1), ('b', 'view', 2), ('b', 'purchase', 1)), n AS (SELECT user_id, event_type AS token, count(*) AS n FROM events GROUP BY ALL),
 p AS (SELECT user_id, marker, CAST(sum(least(n, m)) AS BIGINT) AS overlap FROM n JOIN m USING (token) GROUP BY ALL) SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY overlap DESC, marker) = 1""",
    "figure_references": r"""WITH t AS (SELECT doc_id, replace(replace(text, ' the ', ' FIG. 7 '), ' der ', ' Figures FIGURE' || doc_id % 5 || 'b, configure 4 ') AS text FROM documents),
 m AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?i)\bFIG(?:URE|S)?\s*\.?\s*([0-9]+[A-Z]?)', 1), lambda x: upper(x)) AS xs FROM t),
 u AS (SELECT doc_id, unnest(xs) AS x, unnest(range(len(xs))) AS i FROM m), f AS (SELECT doc_id, x, min(i) AS i FROM u WHERE x NOT IN ('3B', '1') GROUP BY ALL)
 SELECT m.doc_id, coalesce(string_agg(x, ',' ORDER BY f.i), '') AS missing FROM m LEFT JOIN f USING (doc_id) GROUP BY m.doc_id""",
    "document_verdicts": rf"""WITH d AS (SELECT doc_id, text, {DAMAGED} AS cut FROM documents),
 o AS (SELECT *, cut || CASE doc_id % 8 WHEN 3 THEN chr(10) || '# US 10,155,111 B2' || chr(10) WHEN 4 THEN chr(10) || '35' || chr(10) || ' 5 ' || chr(10) || '7' || chr(10) WHEN 5 THEN chr(10) || 'see FIG. 9' || chr(10) WHEN 6 THEN chr(10) || '![US 1,2 B1](x)' || chr(10) || 'in U.S. Patent law' || chr(10) ELSE '' END AS output FROM d),
 l AS (SELECT doc_id, text, cut, output, doc_id % 9 <> 4 AS claims_ok, list_sort(list_distinct(list_filter(list_transform(string_split(regexp_replace(output, '!\[[^\]]*\]\([^)]*\)', '', 'g'), chr(10)), lambda x: trim(regexp_replace(regexp_replace(trim(x, ' '), '^[*#>]+', ''), '[*#>]+$', ''), ' ')),
   lambda x: x <> '' AND length(x) <= 45 AND NOT regexp_matches(x, '^\p{{Ll}}') AND regexp_matches(x, '(?i)(U\.?\s*S\.?\s*Patent|US\s*[0-9,]+\s*B[12]|Sheet\s+[0-9]+\s+of\s+[0-9]+|^US0?[0-9]{{6,}}|\bPage\s+[0-9]+)')))) AS leaked,
   len(list_filter(string_split(output, chr(10)), lambda x: regexp_full_match(trim(x, ' '), '[0-9]?[05]'))) AS lone, regexp_extract_all(output, '(?i)\bFIG(?:URE|S)?\s*\.?\s*([0-9]+[A-Z]?)', 1) AS figs FROM o),
 i AS (SELECT doc_id, 0 AS side, unnest(regexp_extract_all(lower(text), '[a-z0-9]')) AS item FROM o UNION ALL SELECT doc_id, 1, unnest(regexp_extract_all(lower(cut), '[a-z0-9]')) FROM o),
 c AS (SELECT doc_id, item, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM i GROUP BY ALL), m AS (SELECT doc_id, round(CAST(sum(greatest(a - b, 0)) AS DOUBLE) / greatest(sum(a), 1), 5) AS r FROM c GROUP BY doc_id)
 SELECT l.doc_id, array_to_string(leaked, '|') AS leaked, CAST(lone AS INTEGER) AS lone, claims_ok, array_to_string(list_filter(list_distinct(list_transform(figs, lambda x: upper(x))), lambda x: x <> '1'), ',') AS figures, coalesce(r, 0) > 0.005 OR len(leaked) > 0 OR lone > 0 OR NOT claims_ok AS suspect FROM l LEFT JOIN m USING (doc_id)""",
    "page_report": "WITH " + _REPORT + " SELECT conv_id, turn, status, status <> 'UNSCORABLE' AS scored, array_to_string(codes, ',') AS codes FROM r",
    "document_report": "WITH " + _REPORT + """, c AS (SELECT conv_id, code, count(*) AS n FROM (SELECT conv_id, unnest(codes) AS code FROM r) GROUP BY ALL), l AS (SELECT conv_id, string_agg(code || ':' || n, ',' ORDER BY code) AS issues FROM c GROUP BY conv_id),
 g AS (SELECT conv_id, count(*) AS pages, count(*) FILTER (status <> 'UNSCORABLE') AS scored_pages, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (status = 'SUSPECT'), '') AS suspect_pages FROM r GROUP BY conv_id)
 SELECT conv_id, CASE WHEN scored_pages = 0 THEN 'UNSCORABLE' WHEN suspect_pages <> '' OR scored_pages < pages THEN 'SUSPECT' ELSE 'OK' END AS status, pages, scored_pages, suspect_pages, coalesce(issues, '') AS issues FROM g LEFT JOIN l USING (conv_id)""",
    "degeneration_report": r"""WITH t AS (SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\f\v]+', ' ', 'g')) AS t FROM conversations),
 s AS (SELECT conv_id, turn, CASE WHEN length(t) < 8 THEN 0.0::DOUBLE ELSE 1.0 - CAST(len(list_distinct(list_transform(range(1, length(t) - 6), lambda i: substr(t, i, 8)))) AS DOUBLE) / (length(t) - 7) END AS score FROM t)
 SELECT conv_id, max(score) AS max_repetition, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (score > 0.2), '') AS flagged FROM s GROUP BY conv_id""",
    "report_codes": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'audit_report_missing' WHEN o_orderkey % 5 = 0 THEN 'audit_report_corrupt' WHEN o_orderkey % 3 <> 1 OR NOT o_totalprice > 100000 OR o_orderkey % 11 = 0 THEN 'audit_report_stale' END AS code FROM orders""",
}
