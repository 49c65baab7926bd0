"""Ordered rules: routes, page kinds, garbled tokens, error buckets, accept/reject gates, status precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import folds
from folioforge.sources.tables import DAMAGED, damaged, edits, table


def first_match(rules: list[tuple[Column, object]], otherwise=None) -> Column:
    """The value of the first rule that holds."""
    col = reduce(lambda c, r: c.when(*r), rules[1:], F.when(*rules[0]))
    return col.otherwise(otherwise) if otherwise is not None else col


def footer_noise(text: Column) -> Column:
    """A row of page or column numbers only."""
    return text.rlike(r"^[0-9]{1,4}\.?(?:\s+[0-9]{1,4}\.?)?$")


#: Replacement character, private use and control characters.
BAD = r"[\x{FFFD}\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]|[\p{Cc}&&[^\s\x{1C}-\x{1F}\x{85}]]"
MATH = r"[\x{2200}-\x{22FF}\x{27C0}-\x{27EF}\x{2980}-\x{29FF}\x{2A00}-\x{2AFF}\x{1D400}-\x{1D7FF}\x{2190}-\x{21FF}]"


def has_bad_characters(text: Column) -> Column:
    return text.rlike(BAD)


def has_math(text: Column) -> Column:
    return text.rlike(MATH) | text.rlike(r"[$\\]")


#: Fixed value: replacement and private-use characters, which tell a broken text layer.
BROKEN = r"[\x{FFFD}\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"


def triage(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """Route by the text layer of five sampled pages: sparse goes to A, broken to C, else B. Pages count from 0.

    Fixed values: pages at 10, 30, 50, 70 and 90 %, once each; under 50 characters a page is sparse; a quarter of
    replacement and private-use characters among those that are not white space is broken.
    """
    n = pages.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    picked = F.array_distinct(F.array(*[F.least(F.floor(F.col("n").cast("double") * p), F.col("n") - 1).cast("long") for p in (0.1, 0.3, 0.5, 0.7, 0.9)]))
    sampled = pages.join(n.select(key, F.explode(picked).alias(page)), [key, page])
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.regexp_replace(F.regexp_replace(t, r"^\s+", ""), r"\s+$", "")
    sums = sampled.groupBy(key).agg(F.avg(F.length(trimmed)).alias("mean_chars"), F.sum(F.regexp_count(t, F.lit(BROKEN))).alias("bad"), F.sum(F.length(F.regexp_replace(t, r"\s", ""))).alias("visible"))
    share = F.col("bad").cast("double") / F.greatest(F.col("visible"), F.lit(1))
    return sums.select(key, "mean_chars", share.alias("bad_share"), F.when(F.col("mean_chars") < 50, "A").when(share >= 0.25, "C").otherwise("B").alias("route"))


#: Units whose spelling mixes cases.
UNITS = ("Hz", "kHz", "MHz", "GHz", "THz", "dB", "dBm", "dBi", "mAh", "kWh", "mWh", "Wh", "mV", "kV", "mA", "kΩ", "MΩ", "mW", "kW", "MW", "pH", "mmHg", "rpm")


def token_core(token: Column) -> Column:
    return F.regexp_replace(token, r"^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "")


def garble(core: Column, in_dictionary: Column) -> Column:
    """Class of a damaged token: numjoin, casing, mixedcase, or null."""
    camel = core.rlike(r"^(?:[A-Z][a-z]+)+$")
    low, up = F.lower(core), F.upper(core)
    capital = F.concat(F.upper(F.substring(core, 1, 1)), F.lower(F.substring(core, F.lit(2), F.length(core))))
    standard = (core == low) | (core == up) | (core == capital)
    return first_match([
        ((F.length(core) < 2) | core.isin(*UNITS), F.lit(None).cast("string")),
        (core.rlike(r"[0-9]{4}[A-Za-z]{1,2}[0-9]{4,}"), "numjoin"),
        (~core.rlike(r"^\p{L}+$"), F.lit(None).cast("string")),
        (in_dictionary & ~camel & ~standard, "casing"),
        (in_dictionary | camel | (core == up) | core.rlike(r"^[a-z]{1,2}[A-Z]{2,}$"), F.lit(None).cast("string")),
        (core.rlike(r"[^A-Z][A-Z]{2,}"), "mixedcase"),
    ])


def error_bucket(error: Column, latex: Column) -> Column:
    """First matching signature of a render error; a garbled tag outranks text mode."""
    e, x = F.coalesce(error, F.lit("")), F.coalesce(latex, F.lit(""))
    tag = r"\\tag\{[^}]*[\\_]"
    return first_match([
        (e.rlike(tag) | x.rlike(tag), "tag_garble"),
        (e.contains("text mode"), "math_in_text"),
        (e.contains("Double subscript") | e.contains("Double superscript"), "double_script"),
        (e.rlike(r"Undefined control sequence:?\s*\\[a-zA-Z]+"), "undefined_command"),
        (x.rlike(r"\\(begin|end)\{(array|bmatrix)"), "structural_env"),
        (e.contains("Expected '}'") | e.contains("Unexpected end of input") | e.contains("macro argument") | e.contains("Expected group"), "brace_mismatch"),
    ], "other")


def error_detail(error: Column) -> Column:
    return F.nullif(F.regexp_extract(error, r"Undefined control sequence:?\s*(\\[a-zA-Z]+)", 1), F.lit(""))


#: Tokens of a formula, and phrases that tell a failed answer.
LATEX_TOKEN = r"\\[a-zA-Z]+|[a-zA-Z0-9]+|[^\s\\a-zA-Z0-9]"
ERROR_PHRASES = ("error", "quota", "rate limit", "ratelimit", "timeout", "unauthorized", "forbidden", "i cannot", "i can't", "i'm sorry", "sorry,", "unable to", "抱歉", "无法", "失败", "错误")


def normal_formula(text: Column) -> Column:
    """Without outer math marks, white space squeezed; its inside is kept."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    for _ in range(3):
        t = F.trim(F.regexp_replace(F.trim(F.regexp_replace(t, r"^(?:\$\$|\$|\\\[|\\\()", "")), r"(?:\$\$|\$|\\\]|\\\))$", ""))
    return t


def similarity_gate(new: Column, old: Column) -> Column:
    """Why a corrected formula is no repair, or null: empty or an error's text; a length ratio outside 0.5 to 2 with a change of over
    12; under half of the old tokens kept; more new tokens than max(3, old tokens); the same tokens in another order, which
    wants a second opinion. Tokens are compared as sets, on formulas without their outer marks."""
    a, b = normal_formula(new), normal_formula(old)
    split = lambda c: F.regexp_extract_all(c, F.lit(LATEX_TOKEN), F.lit(0))
    x, y = split(a), split(b)
    ratio = F.length(a).cast("double") / F.length(b)
    low = F.lower(F.coalesce(new, F.lit("")))
    failed = reduce(lambda c, p: c | F.contains(low, F.lit(p)), ERROR_PHRASES[1:], F.contains(low, F.lit(ERROR_PHRASES[0])))
    distinct_old = F.size(F.array_distinct(y))
    fresh = F.size(F.array_except(x, y))
    return first_match([
        (F.trim(F.coalesce(new, F.lit(""))) == "", "degenerate_empty"),
        (failed, "degenerate_error_text"),
        (b == "", F.lit(None).cast("string")),
        (a == "", "empty"),
        (~ratio.between(0.5, 2.0) & (F.abs(F.length(a) - F.length(b)) > 12), "length_ratio"),
        (distinct_old == 0, F.lit(None).cast("string")),
        (F.size(F.array_intersect(x, y)).cast("double") / distinct_old < 0.5, "overlap"),
        (fresh > F.greatest(F.lit(3), distinct_old), "new_tokens"),
        ((fresh == 0) & (F.size(F.array_except(y, x)) == 0) & (x != y), "pure_reorder"),
    ])


#: Labels whose source text may be adopted.
ADOPTABLE = ("text", "abstract", "reference_content", "content", "paragraph_title", "doc_title", "figure_title", "footnote")


#: Fixed value: traces of formulas in recognised text.
MARKUP = r"[$\\]"


def adoption(label: Column, unscorable: Column, source: Column, output: Column, source_compare: Column, output_compare: Column, adopted_compare: Column) -> Column:
    """The first of the gates that fails, or null. source and output are as read; the others are normalised for comparison, and
    adopted_compare is the source joined as it would be adopted. The edit distance is reached only where the cheap gates pass."""
    visible = lambda c: F.length(F.regexp_replace(c, r"\s", ""))
    ratio = visible(source_compare).cast("double") / visible(output_compare)
    ned = F.levenshtein(adopted_compare, output_compare).cast("double") / F.greatest(F.length(adopted_compare), F.length(output_compare), F.lit(1))
    return first_match([
        (~F.coalesce(label.isin(*ADOPTABLE), F.lit(False)), "label_not_adoptable"),
        (unscorable, "geometry_unscorable"),
        ((visible(source) == 0) | (visible(output_compare) == 0), "char_ratio_out_of_range"),
        (~ratio.between(0.5, 2.0), "char_ratio_out_of_range"),
        (has_bad_characters(source), "bad_source_chars"),
        (output.rlike(MARKUP) | source.rlike(MATH), "math_in_prose_block"),
        (F.trim(adopted_compare) == "", "unreconstructable"),
        (ned > 0.2, "adoption_disagreement"),
    ])


def completion(status: Column) -> Column:
    """Highest-priority status of a group (aggregate): FAILED over SUSPECT over OK; none is OK."""
    rank = F.when(status == "FAILED", 3).when(status == "SUSPECT", 2).otherwise(1)
    return F.coalesce(F.max_by(status, rank), F.lit("OK"))


def circuit_breaker(changed: Column, total: Column, ratio: float = 0.6, least: int = 5) -> Column:
    return (total >= least) & (changed.cast("double") / total > ratio)


def unordered_class(label: Column, content: Column, x0: Column, x1: Column, width: Column) -> Column:
    """Class of a block that has no reading order."""
    t, compact = F.trim(F.coalesce(content, F.lit(""))), F.lower(F.regexp_replace(F.coalesce(content, F.lit("")), r"\s+", ""))
    edge = (x1 <= width * 0.06) | (x0 >= width * 0.93)
    signal = compact.rlike("licensedcopy:|copyright|iso|2018|©")
    aside = (compact == "") | compact.startswith("licensedcopy:") | compact.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") | compact.rlike(r"^\d{1,3}$") | (F.coalesce(edge, F.lit(False)) & signal)
    return first_match([
        (t == "", "empty_visual"),
        (label.isin("header", "footer", "page_number", "number", "seal", "watermark"), "likely_furniture"),
        (label.isin("image", "chart", "table", "figure_title", "footer_image"), "structural_visual"),
        ((label == "aside_text") & aside, "likely_furniture"),
        (label.isin("vision_footnote", "text", "reference_content", "paragraph_title", "table_caption", "figure_caption", "display_formula", "inline_formula"), "review_content"),
    ], "unknown_visual")


#: Anomalies of a repair run and of a formula run, in order of precedence.
RUN_FLAGS = ("report_error", "off", "run_error", "rolled_back", "conflicts", "P0_findings", "P1_findings", "apply_blocked")
FORMULA_FLAGS = ("circuit_broken", "rolled_back")


def run_flag(mode: Column, status: Column, rolled_back: Column, conflicts: Column, p0: Column, p1: Column, reason: Column) -> Column:
    """The first anomaly of a repair run, or null; a run that was off has none, and an empty plan blocks nothing."""
    cond = ((mode == "unknown") & (status == "error"), mode == "off", status == "error", rolled_back, conflicts > 0, p0 > 0, p1 > 0, (F.coalesce(reason, F.lit("")) != "") & (reason != "empty patch plan"))
    return first_match([(F.coalesce(c, F.lit(False)), F.lit(None).cast("string") if name == "off" else name) for c, name in zip(cond, RUN_FLAGS, strict=True)])


def formula_flag(circuit_broken: Column, rolled_back: Column) -> Column:
    return first_match([(F.coalesce(c, F.lit(False)), name) for c, name in zip((circuit_broken, rolled_back), FORMULA_FLAGS, strict=True)])


def triage_route(spark, sf_dir):
    """Conversations as documents; some have bad characters in proportion to each page."""
    text = F.when(F.col("conv_id") % 11 == 0, F.concat("text", F.expr("repeat('\ufffd', cast(length(text) div 3 as int))"))).when(F.col("conv_id") % 11 == 1, F.concat("text", F.lit("\u0007" * 50))).otherwise(F.col("text"))
    return triage(table(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("text")), "conv_id", "turn", "text")


def garble_tokens(spark, sf_dir):
    """Damaged tokens of the documents, against a dictionary of tokens that are frequent in them."""
    docs = table(spark, sf_dir, "documents")
    tokens = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+"), F.lit(0)))).alias("core"))
    tokens = tokens.select("doc_id", F.when(F.col("doc_id") % 13 == 0, F.concat(F.lower("core"), F.lit("S"))).otherwise(F.col("core")).alias("core"))
    known = tokens.groupBy(F.lower("core").alias("low")).agg(F.count(F.lit(1)).alias("n")).where("n >= 20").select("low", F.lit(True).alias("known"))
    rows = tokens.join(known, F.lower("core") == F.col("low"), "left")
    kinds = rows.select("doc_id", garble(F.col("core"), F.coalesce("known", F.lit(False))).alias("kind")).where("kind IS NOT NULL")
    return kinds.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def error_buckets(spark, sf_dir):
    """Render errors over the texts of documents, bucketed and counted with a first sample."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.translate("text", "\\", "/").alias("text"))
    kinds = ["Undefined control sequence: \\upmu", "Double subscript at 3", "can't use in text mode: ", "Expected '}' got EOF", "no idea"]
    message = F.concat(F.element_at(F.array(*map(F.lit, kinds)), (F.length("text") % 5 + 1).cast("int")), F.lit(" "), F.col("text"))
    latex = F.when(F.col("text").contains("the"), F.concat(F.col("text"), F.lit("\\tag{3_1}"))).when(F.col("text").contains("der"), F.concat(F.lit("\\begin{array}{c}"), F.col("text"))).otherwise(F.col("text"))
    rows = docs.select("doc_id", error_bucket(message, latex).alias("bucket"), error_detail(message).alias("detail"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.count("detail").alias("with_detail"))


def similarity_gates(spark, sf_dir):
    """Damaged copies as corrections: marks added, operators changed, letters' case changed (each stays one letter), words reversed, or an
    error's text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", damaged(F.col("text"), F.col("doc_id")).alias("output"))
    k = F.col("doc_id") % 10
    new = F.when(k == 3, F.concat(F.lit("$$ "), "output", F.lit(" $$"))).when(k == 4, F.upper(F.replace("output", F.lit("ß"), F.lit("ẞ")))).when(k == 5, F.array_join(F.reverse(F.split("output", " ")), " ")).when(k == 6, F.concat("output", F.lit(" Quota exceeded"))).when(k == 7, F.lit(" ")).when(k == 8, F.translate("output", "aeiou", "+-*/=")).otherwise(F.col("output"))
    return docs.select("doc_id", similarity_gate(new, F.col("text")).alias("reason"))


def adoption_gates(spark, sf_dir):
    """Benchmark passages as blocks: their words against a damaged copy, with bad characters, formulas and blank texts among them."""
    labels = F.element_at(F.array(*map(F.lit, ["text", "table", "abstract", "content", "footnote"])), (F.col("item_id") % 5 + 1).cast("int"))
    k = F.col("item_id") % 17
    source = F.when(k == 3, F.concat("text", F.lit(" \ue000"))).when(k == 5, F.concat("text", F.lit(" ∑"))).when(k == 7, F.lit(" ")).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "benchmark").select("item_id", "text", labels.alias("label"), source.alias("source"), F.when(k == 9, F.concat(F.lit("$x$ "), "text")).when(k == 11, F.lit("")).otherwise(damaged(F.col("text"), F.col("item_id"))).alias("output"))
    compare = folds.text_udf(lambda t: folds.normalize_prose(t, True), "string")
    adopted = folds.text_udf(lambda t: folds.normalize_prose(folds.join_words(t.split()), True), "string")
    reason = adoption(F.col("label"), F.col("item_id") % 9 == 0, F.col("source"), F.col("output"), compare(F.col("source")), compare(F.col("output")), adopted(F.col("source")))
    return rows.select("item_id", reason.alias("reason"), F.when(reason.isNull(), "source_text").otherwise("ocr").alias("content_source"))


def status_rollup(spark, sf_dir):
    """Status by source, documents without labels counting as sound, and a breaker on the share that changed."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    status = F.when(F.col("toxic") == 1, "FAILED").when(F.col("quality") == 0, "SUSPECT").otherwise("OK")
    out = rows.groupBy("source").agg(completion(status).alias("status"), F.count_if(F.col("quality") == 0).alias("changed"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("tripped", circuit_breaker(F.col("changed"), F.col("total")))


def unordered_blocks(spark, sf_dir):
    """Whole documents as blocks without an order, some blank, some dates or page numbers, on places across the page."""
    labels = ["header", "image", "aside_text", "vision_footnote", "text", "formula", "seal", "aside_text"]
    k = F.col("doc_id")
    label = F.element_at(F.array(*map(F.lit, labels)), (k % 8 + 1).cast("int"))
    content = F.when(k % 9 == 0, " ").when(k % 9 == 1, "12/ 10/2020").when(k % 9 == 2, F.concat(F.lit("Copyright "), "text")).when(k % 9 == 3, "4 2").when(k % 9 == 4, F.concat(F.lit("Licensed Copy: "), "text")).otherwise(F.col("text"))
    x0 = (k * 7 % 100).cast("double")
    return table(spark, sf_dir, "documents").select("doc_id", unordered_class(label, content, x0, x0 + 5, F.lit(100.0)).alias("kind"))


def anomaly_flags(spark, sf_dir):
    """Flags of runs, one a customer, from its orders."""
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"), F.count_if(F.col("o_orderstatus") == "F").alias("failed"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    k = F.col("o_custkey") % 10
    flag = run_flag(F.when(k == 0, "unknown").when(k == 1, "off").otherwise("apply"), F.when(k <= 2, "error").otherwise("OK"), F.col("top") > 400000, F.greatest(F.col("n") - 14, F.lit(0)), F.greatest(F.col("urgent") - 4, F.lit(0)), F.greatest(F.col("urgent") - 2, F.lit(0)), F.when(k == 5, "empty patch plan").when(k == 6, "locked"))
    return rows.select("o_custkey", flag.alias("flag"), formula_flag(circuit_breaker(F.col("failed"), F.col("n")), F.col("top") > 300000).alias("formula_flag"))


QUERIES = {f.__name__: f for f in (triage_route, garble_tokens, error_buckets, similarity_gates, adoption_gates, status_rollup, unordered_blocks, anomaly_flags)}

_BARE = r"""trim(regexp_replace(coalesce({0}, ''), '\s+', ' ', 'g'), ' ')"""
ORACLE = {
    "triage_route": r"""WITH t AS (SELECT conv_id, turn, CASE WHEN conv_id % 11 = 0 THEN text || repeat(chr(65533), CAST(length(text) // 3 AS INTEGER)) WHEN conv_id % 11 = 1 THEN text || repeat(chr(7), 50) ELSE text END AS text FROM conversations),
 n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id), p AS (SELECT DISTINCT conv_id, least(CAST(floor(CAST(n AS DOUBLE) * k) AS BIGINT), n - 1) AS turn FROM n, (VALUES (0.1::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE), (0.9::DOUBLE)) v(k)),
 s AS (SELECT conv_id, avg(length(regexp_replace(regexp_replace(coalesce(text, ''), '^\s+', ''), '\s+$', ''))) AS mean_chars, sum(length(text) - length(replace(text, chr(65533), ''))) AS bad, sum(length(regexp_replace(text, '\s', '', 'g'))) AS visible FROM t JOIN p USING (conv_id, turn) GROUP BY conv_id)
 SELECT conv_id, mean_chars, CAST(bad AS DOUBLE) / greatest(visible, 1) AS bad_share, CASE WHEN mean_chars < 50 THEN 'A' WHEN CAST(bad AS DOUBLE) / greatest(visible, 1) >= 0.25 THEN 'C' ELSE 'B' END AS route FROM s""",
    "garble_tokens": """WITH t AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS c FROM documents),
 k AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN lower(c) || 'S' ELSE c END AS core FROM t),
 d AS (SELECT lower(core) AS low FROM k GROUP BY 1 HAVING count(*) >= 20),
 g AS (SELECT doc_id, core, low IS NOT NULL AS known, regexp_full_match(core, '([A-Z][a-z]+)+') AS camel FROM k LEFT JOIN d ON lower(core) = low),
 r AS (SELECT doc_id, CASE WHEN length(core) < 2 OR core IN ('Hz', 'kHz', 'MHz', 'GHz', 'THz', 'dB', 'dBm', 'dBi', 'mAh', 'kWh', 'mWh', 'Wh', 'mV', 'kV', 'mA', 'mW', 'kW', 'MW', 'pH', 'mmHg', 'rpm') THEN NULL
   WHEN regexp_matches(core, '[0-9]{4}[A-Za-z]{1,2}[0-9]{4,}') THEN 'numjoin' WHEN NOT regexp_full_match(core, '[A-Za-z]+') THEN NULL
   WHEN known THEN CASE WHEN camel OR core IN (lower(core), upper(core), upper(substr(core, 1, 1)) || lower(substr(core, 2))) THEN NULL ELSE 'casing' END
   WHEN camel OR core = upper(core) OR regexp_full_match(core, '[a-z]{1,2}[A-Z]{2,}') THEN NULL
   WHEN regexp_matches(core, '[^A-Z][A-Z]{2,}') THEN 'mixedcase' END AS kind FROM g)
 SELECT doc_id, kind, count(*) AS n FROM r WHERE kind IS NOT NULL GROUP BY ALL""",
    "error_buckets": r"""WITH d AS (SELECT doc_id, length(text) % 5 AS k, contains(text, 'the') AS t, contains(text, 'der') AS s, contains(text, 'text mode') AS m FROM documents),
 r AS (SELECT *, CASE WHEN t THEN 'tag_garble' WHEN k = 2 OR m THEN 'math_in_text' WHEN k = 1 THEN 'double_script' WHEN k = 0 THEN 'undefined_command' WHEN s THEN 'structural_env' WHEN k = 3 THEN 'brace_mismatch' ELSE 'other' END AS bucket FROM d)
 SELECT bucket, count(*) AS n, min(doc_id) AS first, count(*) FILTER (k = 0) AS with_detail FROM r GROUP BY bucket""",
    "similarity_gates": rf"""WITH d AS (SELECT doc_id, text, {DAMAGED} AS output FROM documents),
 e AS (SELECT doc_id, text, CASE doc_id % 10 WHEN 3 THEN '$$ ' || output || ' $$' WHEN 4 THEN upper(output) WHEN 5 THEN array_to_string(list_reverse(string_split(output, ' ')), ' ') WHEN 6 THEN output || ' Quota exceeded' WHEN 7 THEN ' ' WHEN 8 THEN translate(output, 'aeiou', '+-*/=') ELSE output END AS output FROM d),
 f AS (SELECT doc_id, output AS raw, {_BARE.format("CASE WHEN doc_id % 10 = 3 THEN output[4:-4] ELSE output END")} AS a, {_BARE.format("text")} AS b FROM e),
 g AS (SELECT *, regexp_replace(regexp_replace(trim(regexp_replace(a, '^[$ ]+', '')), '[$ ]+$', ''), '^$', '') AS x, regexp_replace(trim(regexp_replace(b, '^[$ ]+', '')), '[$ ]+$', '') AS y FROM f),
 t AS (SELECT *, regexp_extract_all(x, '[a-zA-Z0-9]+|[^\sa-zA-Z0-9]') AS p, regexp_extract_all(y, '[a-zA-Z0-9]+|[^\sa-zA-Z0-9]') AS q FROM g),
 s AS (SELECT *, len(list_distinct(q)) AS nb, len(list_intersect(p, q)) AS common, len(list_distinct(p)) - len(list_intersect(p, q)) AS fresh FROM t)
 SELECT doc_id, CASE WHEN coalesce(trim(raw, ' '), '') = '' THEN 'degenerate_empty' WHEN regexp_matches(lower(raw), 'error|quota|rate limit|ratelimit|timeout|unauthorized|forbidden|i cannot|i can''t|i''m sorry|sorry,|unable to') THEN 'degenerate_error_text' WHEN y = '' THEN NULL WHEN x = '' THEN 'empty'
   WHEN NOT CAST(length(x) AS DOUBLE) / length(y) BETWEEN 0.5 AND 2.0 AND abs(length(x) - length(y)) > 12 THEN 'length_ratio' WHEN nb = 0 THEN NULL
   WHEN CAST(common AS DOUBLE) / nb < 0.5 THEN 'overlap' WHEN fresh > greatest(3, nb) THEN 'new_tokens' WHEN fresh = 0 AND common = nb AND p <> q THEN 'pure_reorder' END AS reason FROM s""",
    "adoption_gates": rf"""WITH p AS (SELECT item_id, item_id % 17 AS k, text, CASE item_id % 17 WHEN 3 THEN text || ' ' || chr(57344) WHEN 5 THEN text || ' ∑' WHEN 7 THEN ' ' ELSE text END AS source, CASE item_id % 17 WHEN 9 THEN '$x$ ' || text WHEN 11 THEN '' ELSE {DAMAGED.replace('doc_id', 'item_id')} END AS output FROM benchmark),
 c AS (SELECT *, {_BARE.format("source")} AS a, {_BARE.format("output")} AS b FROM p),
 g AS (SELECT item_id, CASE WHEN item_id % 5 = 1 THEN 'label_not_adoptable' WHEN item_id % 9 = 0 THEN 'geometry_unscorable' WHEN trim(source, ' ') = '' OR b = '' THEN 'char_ratio_out_of_range'
   WHEN NOT CAST(length(regexp_replace(a, '\s', '', 'g')) AS DOUBLE) / length(regexp_replace(b, '\s', '', 'g')) BETWEEN 0.5 AND 2.0 THEN 'char_ratio_out_of_range' WHEN k = 3 THEN 'bad_source_chars' WHEN k IN (5, 9) OR contains(output, '$') THEN 'math_in_prose_block'
   WHEN CAST({edits("a", "b")} AS DOUBLE) / greatest(length(a), length(b), 1) > 0.2 THEN 'adoption_disagreement' END AS reason FROM c)
 SELECT item_id, reason, CASE WHEN reason IS NULL THEN 'source_text' ELSE 'ocr' END AS content_source FROM g""",
    "status_rollup": """SELECT source, CASE WHEN max(toxic) = 1 THEN 'FAILED' WHEN min(quality) = 0 THEN 'SUSPECT' ELSE 'OK' END AS status, count(*) FILTER (quality = 0) AS changed, count(*) AS total,
 count(*) >= 5 AND CAST(count(*) FILTER (quality = 0) AS DOUBLE) / count(*) > 0.6 AS tripped FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
    "unordered_blocks": r"""WITH b AS (SELECT doc_id, (['header', 'image', 'aside_text', 'vision_footnote', 'text', 'formula', 'seal', 'aside_text'])[doc_id % 8 + 1] AS label, doc_id * 7 % 100 AS x,
  CASE doc_id % 9 WHEN 0 THEN ' ' WHEN 1 THEN '12/ 10/2020' WHEN 2 THEN 'Copyright ' || text WHEN 3 THEN '4 2' WHEN 4 THEN 'Licensed Copy: ' || text ELSE text END AS c FROM documents),
 n AS (SELECT *, lower(regexp_replace(c, '\s', '', 'g')) AS k FROM b)
 SELECT doc_id, CASE WHEN trim(c, ' ') = '' THEN 'empty_visual' WHEN label IN ('header', 'seal') THEN 'likely_furniture' WHEN label = 'image' THEN 'structural_visual'
  WHEN label = 'aside_text' AND (k LIKE 'licensedcopy:%' OR regexp_full_match(k, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') OR regexp_full_match(k, '[0-9]{1,3}') OR ((x + 5 <= 6 OR x >= 93) AND regexp_matches(k, 'licensedcopy:|copyright|iso|2018|©'))) THEN 'likely_furniture'
  WHEN label IN ('vision_footnote', 'text') THEN 'review_content' ELSE 'unknown_visual' END AS kind FROM n""",
    "anomaly_flags": """WITH g AS (SELECT o_custkey, o_custkey % 10 AS k, count(*) AS n, max(o_totalprice) AS top, count(*) FILTER (o_orderstatus = 'F') AS failed, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY o_custkey)
 SELECT o_custkey, CASE WHEN k = 0 THEN 'report_error' WHEN k = 1 THEN NULL WHEN k = 2 THEN 'run_error' WHEN top > 400000 THEN 'rolled_back' WHEN n > 14 THEN 'conflicts' WHEN urgent > 4 THEN 'P0_findings' WHEN urgent > 2 THEN 'P1_findings' WHEN k = 6 THEN 'apply_blocked' END AS flag,
  CASE WHEN n >= 5 AND CAST(failed AS DOUBLE) / n > 0.6 THEN 'circuit_broken' WHEN top > 300000 THEN 'rolled_back' END AS formula_flag FROM g""",
}
