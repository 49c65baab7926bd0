"""Pages and documents as Markdown: from words in columns, and from recognised blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import folds
from folioforge.functions import text as T
from folioforge.operators import geometry as G
from folioforge.operators import tables
from folioforge.operators.audit import crop_name, is_visual
from folioforge.operators.classify import garble, token_core
from folioforge.sources.tables import WORDS, table, words


def noise(rows: DataFrame, doc: str, page: str, height: float, width: float) -> DataFrame:
    """Pages of words: doc, page, kind, gutter, and words, an array with the noise of each: header_footer for words of lines in the bands
    that look like running headers or number rows, line_number for numbers at the gutter of body pages, else null. Judged on the
    words' own places, so a second reading of a page can be checked alone."""
    pages = G.strip_bands(G.page_kinds(rows, [doc], page, width, G.packed_words().alias("words"), G.median_height().alias("_h")), height)
    number = lambda w: (F.col("kind") == "SPEC_BODY") & G.is_line_number(w["word"], (w["x0"] + w["x1"]) / 2, F.col("gutter"))
    told = lambda w, removed: F.when(F.array_contains(removed, w["ix"]), "header_footer").when(number(w), "line_number")
    marked = G.bound(F.col("removed"), lambda removed: F.transform("words", lambda w: F.struct(*(w[c].alias(c) for c in G.WORD), told(w, removed).alias("noise"))))
    return pages.select(doc, page, "kind", "gutter", marked.alias("words"))


def column_lines(pages: DataFrame, page: list[str], by_column: bool = True) -> DataFrame:
    """Lines of pages' words without noise, by column on request: page, col, line_no, text, x0, y, and the widths and heights they were
    judged by."""
    own = pages.select(*page, "gutter", F.filter("words", lambda w: w["noise"].isNull()).alias("words"))
    own = own.select("*", G.char_width(F.col("words")).alias("_cw"), G.word_height(F.col("words")).alias("line_height"))
    side = lambda w: G.column_of((w["x0"] + w["x1"]) / 2, F.col("gutter"))
    part = lambda c: F.struct(F.lit(c).alias("col"), F.filter("words", lambda w: side(w) == c).alias("w"))
    parts = F.array(part("L"), part("R")) if by_column else F.array(F.struct(F.lit("L").alias("col"), F.col("words").alias("w")))
    cols = own.select(*page, "_cw", "line_height", F.inline(parts)).where(F.size("w") > 0)
    lines = G.in_lines(cols.withColumn("char_width", G.char_width(F.col("w"))), {"w": "lines"}, F.col("line_height") * G.LINE_SHARE)
    told = F.transform("lines", lambda line: F.struct(
        G.line_text(line, F.greatest(F.lit(G.SPACE), F.col("_cw") * G.SPACE_SHARE)).alias("text"), F.get(line, F.lit(0))["x0"].alias("x0"), G.middle(F.transform(line, G.centre)).alias("y")))
    return lines.select(*page, "col", "char_width", "line_height", F.posexplode(told).alias("line_no", "l")).select(*page, "col", "line_no", "l.*", "char_width", "line_height")


def body_paragraphs(pages: DataFrame, page: list[str]) -> DataFrame:
    """Paragraphs of body pages, left column before right: page, col, para, text, lines, new_by. Lines are dealt by document, where its
    paragraphs meet."""
    lines = column_lines(pages.where("kind = 'SPEC_BODY'"), page).repartition(page[0])
    return G.paragraphs(lines, [*page, "col"], F.col("char_width"), F.col("line_height"))


def body_texts(paras: DataFrame, doc: str, page: str) -> DataFrame:
    """Each document's paragraphs, joined over columns and pages, blank lines between."""
    merged = G.merge_continuations(paras, [doc], [page, "col", "para"]).withColumn("text", F.trim("text")).where("text <> ''")
    return merged.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("merged", "text"))), lambda m: m["text"]), "\n\n").alias("body"))


def front_texts(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """Each document's front pages, line by line, blank lines between pages."""
    lines = column_lines(pages.where("kind = 'FRONT_MATTER'"), [doc, page], by_column=False).repartition(doc)
    texts = lines.groupBy(doc, page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n").alias("t"))
    return texts.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, "t"))), lambda x: x["t"]), "\n\n").alias("front"))


#: Notices where claims were found but have no numbers, and where none were found.
UNNUMBERED = "> [转换提示] 权项编号未能自动结构化，以下为原文。"
NO_CLAIMS = "> [转换提示] 未检测到标准 claims 标记，权利要求可能并入说明书。"


def assemble(meta: dict, body: str, front: str, figures: list[str], is_word) -> str:
    """A document's Markdown, in fixed order: header, title, abstract, description with headings, claims or a notice, drawing sheets,
    front pages."""
    body = folds.rejoin_words(folds.strip_title(body, meta.get("title") or ""), is_word)
    low = body.lower()
    at = min((i for i in (low.find(m.lower()) for m in T.CLAIMS) if i >= 0), default=-1)
    spec, claims = (body, "") if at < 0 else (body[:at].rstrip(), body[at:].strip())
    parts = [folds.yaml_header({k: meta.get(k) or ([] if k in ("inventors", "classes") else "") for k in ("number", "title", "inventors", "assignee", "date", "classes", "topic", "source")}), ""]
    parts += [f"# {meta['title']}\n"] if meta.get("title") else []
    parts += ["## Abstract\n", folds.rejoin_words(meta["abstract"], is_word) + "\n"] if meta.get("abstract") else []
    described = folds.mark_headings(spec)
    parts += [described + "\n"] if described.strip() else []
    numbered = "\n\n".join(t for _, t in folds.structure_claims(claims))
    if numbered:
        parts += ["## Claims\n", numbered + "\n"]
    elif claims:
        parts += ["## Claims\n", UNNUMBERED + "\n", " ".join(claims.split()) + "\n"]
    elif body:
        parts.append(NO_CLAIMS + "\n")
    if figures:
        parts += ["## Figures\n", *(f"![Drawing Sheet {i}]({x})\n\n*Drawing Sheet {i}*\n" for i, x in enumerate(figures, 1))]
    parts += ["## References Cited & Classifications\n", front + "\n"] if front.strip() else []
    return folds.clean_markdown("\n".join(parts))


def compose_documents(rows: DataFrame, metas: DataFrame, doc: str, page: str, height: float, width: float, known: frozenset[str] = frozenset()) -> DataFrame:
    """Words (doc, page, ix, word, box) and metas (doc, number, title, inventors, assignee, date, classes, topic, source, abstract) to
    Markdown, one row a document. known is the dictionary for words broken at line ends."""
    key = [doc, page]
    marked = noise(rows, doc, page, height, width)
    sheets = G.page_kinds(rows, [doc], page, width).where("kind = 'FIGURE'").groupBy(doc).agg(F.array_sort(F.collect_list(page)).alias("_s"))
    out = metas.join(body_texts(body_paragraphs(marked, key), doc, page), doc, "left").join(front_texts(marked, doc, page), doc, "left").join(sheets, doc, "left")
    out = out.withColumn("figures", F.transform(F.coalesce("_s", F.array().cast("array<int>")), lambda p: F.format_string("%s_artifacts/page_%04d.png", F.col("number"), p + 1)))
    names = ("number", "title", "inventors", "assignee", "date", "classes", "topic", "source", "abstract")

    @F.arrow_udf("string")
    def run(meta, body, front, figures):
        import pyarrow as pa

        return pa.array([assemble(m, b or "", f or "", g or [], lambda w: w.lower() in known) for m, b, f, g in zip(*(x.to_pylist() for x in (meta, body, front, figures)), strict=True)], pa.string())

    return out.select(doc, run(F.struct(*names), "body", "front", "figures").alias("markdown"))


def pages_to_read(pages: DataFrame, rows: DataFrame, kinds: DataFrame, known: DataFrame, asked: DataFrame, page: list[str], force: bool = False) -> DataFrame:
    """Pages to recognise anew: those without words, those asked for, and body pages with a garbled word; all where forced."""
    if force:
        return pages.select(*page).distinct()
    textless = pages.join(rows.select(*page).distinct(), page, "left_anti")
    # A word in lower case without four digits is never garbled, whatever the dictionary; the others are few.
    odd = rows.where((F.col("word") != F.lower("word")) | F.col("word").rlike("[0-9]{4}"))
    core = odd.join(kinds.where("kind = 'SPEC_BODY'").select(*page), page, "left_semi").select(*page, token_core(F.col("word")).alias("_c"))
    broken = core.join(known.select(F.col("word").alias("_w")).withColumn("_k", F.lit(True)), F.lower("_c") == F.col("_w"), "left").where(garble(F.col("_c"), F.coalesce("_k", F.lit(False))).isNotNull())
    return textless.select(*page).unionByName(asked.join(pages, page, "left_semi").select(*page)).unionByName(broken.select(*page)).distinct()


def keeps_reading(kind: Column, was_textless: Column) -> Column:
    """A page that had no words keeps recognised text only if that makes it a cover or a body page."""
    return ~was_textless | kind.isin("SPEC_BODY", "COVER")


def column_retry(rows: DataFrame, known: DataFrame, page: list[str]) -> DataFrame:
    """Pages of five words or more: heights at index n/10 and n/2, words as high as 1.6 times the lower one that no dictionary has, and
    whether columns want another reading: heights 1.3 apart and two such words."""
    heights = G.height_split(rows, page, F.col("y1") - F.col("y0"))
    core = F.lower(F.regexp_replace("word", r"^[^\p{L}]+|[^\p{L}]+$", ""))
    tall = rows.join(heights.select(*page, "p10"), page).where((F.col("p10") > 0) & (F.col("y1") - F.col("y0") >= 1.6 * F.col("p10"))).select(*page, core.alias("_c")).where("_c <> ''")
    odd = tall.join(known.select(F.col("word").alias("_c")), "_c", "left_anti").groupBy(*page).agg(F.count(F.lit(1)).alias("suspects"))
    size = rows.groupBy(*page).agg(F.count(F.lit(1)).alias("_n"))
    out = heights.join(size, page).join(odd, page, "left").withColumn("suspects", F.when(F.col("_n") >= 5, F.coalesce("suspects", F.lit(0))).otherwise(0))
    return out.select(*page, "p10", "p50", "suspects", (F.col("bimodal") & (F.col("suspects") >= 2)).alias("retry"))


def ladder_band(rows: DataFrame, page: list[str], width: float) -> DataFrame:
    """The band of line numbers: where the multiples of five up to 80 in the page's middle third stand, 3 points wider; else the middle."""
    xc = (F.col("x0") + F.col("x1")) / 2
    number = F.when(F.col("word").rlike("^[0-9]{1,9}$"), F.col("word").cast("int"))
    rung = (number % 5 == 0) & number.between(1, 80) & xc.between(width / 3, width * 2 / 3)
    side = lambda c, d: F.round(c + d, 1)
    return rows.groupBy(*page).agg(side(F.coalesce(F.min(F.when(rung, F.col("x0"))), F.lit(width / 2)), -3.0).alias("lo"), side(F.coalesce(F.max(F.when(rung, F.col("x1"))), F.lit(width / 2)), 3.0).alias("hi"))


#: Labels of prose, of blocks that pass without an order, and of noise.
PROSE, PASSED, NOISE = ("text", "abstract", "reference_content"), ("footnote", "figure_title", "vision_footnote"), ("header", "number", "header_image")
DOTTED = r"\\underset\s*\{\s*\\cdot\s*\}\s*\{([^{}]*)\}"


def undotted(text: Column) -> Column:
    """Emphasis dots, set as formulas, back as plain letters."""
    wrapped = F.regexp_replace(text, rf"\$\s*((?:{DOTTED}\s*)+)\$", "$1")
    return F.regexp_replace(wrapped, DOTTED, "$1")


def ordered_fragments(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Markdown of ordered blocks (block_order, label, content, y0): page, pos, y0, md. A formula takes the number that follows it as its
    tag; blank blocks go; a document title beside paragraph titles is one of them."""
    w = Window.partitionBy(*page).orderBy("block_order", "source_index")
    tight, clean = folds.text_udf(folds.tighten, "string"), folds.text_udf(folds.sanitize_latex, "string")
    rows = blocks.where("block_order IS NOT NULL").withColumn("c", F.trim(F.coalesce("content", F.lit(""))))
    rows = rows.withColumn("_nl", F.lead("label").over(w)).withColumn("_nc", F.lead("c").over(w)).withColumn("_pl", F.lag("label").over(w)).withColumn("_pc", F.lag("c").over(w)).withColumn("pos", F.row_number().over(w))
    titled = F.max(F.when(F.col("label") == "paragraph_title", 1).otherwise(0)).over(Window.partitionBy(*page)) == 1
    rows = rows.withColumn("_titled", titled).where("c <> '' AND NOT coalesce(label = 'formula_number' AND _pl = 'display_formula' AND _pc <> '', false)")
    label = F.col("label")
    plain = tight(undotted(F.col("c")))
    formula = clean(T.formula_body(F.col("c")))
    tagged = F.concat(F.lit("$$ "), T.strip_tags(formula), F.lit(" \\tag{"), clean(F.regexp_replace("_nc", r"^\(?([\w.\-]+)\)?$", "$1")), F.lit("} $$"))
    md = F.when(label == "paragraph_title", F.concat(F.lit("## "), tight(F.col("c")))).when(label.isin(*PROSE), plain).when(label == "content", T.hard_breaks(F.col("c"))).when(label == "algorithm", T.code_fence(F.col("c"))) \
        .when((label == "doc_title") & F.col("_titled"), F.concat(F.lit("## "), "c")).when(label == "doc_title", T.hard_breaks(F.col("c"))).when((label == "display_formula") & (F.col("_nl") == "formula_number"), tagged) \
        .when(label == "display_formula", F.concat(F.lit("$$ "), formula, F.lit(" $$"))).when(label == "inline_formula", tight(F.col("c"))).otherwise(F.col("c"))
    return rows.select(*page, "pos", F.coalesce("y0", F.lit(0.0)).alias("y0"), md.alias("md"))


def unordered_extras(blocks: DataFrame, page: list[str], stem: Column) -> DataFrame:
    """Markdown of blocks without an order: page, seq, y0, md, warning. Pictures with a place are references, with what text they have
    below; without a place they are a warning. Tables are pipes where they are simple. Notes pass, but a vision_footnote that
    the page's ordered text or an earlier one has does not. Noise goes; other labels with text are a warning."""
    squeezed = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    told = blocks.where("block_order IS NOT NULL").groupBy(*page).agg(squeezed(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_index", F.coalesce("content", F.lit("")).alias("c")))), lambda b: b["c"]), "\n")).alias("_told"))
    rows = blocks.where("block_order IS NULL").join(told, page, "left").withColumn("c", F.trim(F.coalesce("content", F.lit("")))).withColumn("_n", squeezed(F.col("content")))
    again = F.row_number().over(Window.partitionBy(*page, "label", "_n").orderBy("source_index")) > 1
    rows = rows.withColumn("_again", (F.col("label") == "vision_footnote") & (F.col("_n") != "") & (again | F.coalesce(F.contains("_told", F.col("_n")), F.lit(False))))
    label, full = F.col("label"), F.col("c") != ""
    tight = folds.text_udf(folds.tighten, "string")
    visual, boxed = is_visual(label), F.col("y0").isNotNull()
    picture = F.concat(F.lit("![]("), stem, F.lit(".assets/"), crop_name(label, F.lit(None), F.col(page[-1]), F.col("block_id")), F.lit(")"), F.when(full, F.concat(F.lit("\n\n"), undotted(F.col("c")))).otherwise(""))
    md = F.when(visual & boxed, picture).when(visual, None).when((label == "table") & full, F.coalesce(tables.parsed(F.col("c"))["markdown"], tight(undotted(F.col("c"))))).when(label.isin(*PASSED) & full & ~F.col("_again"), tight(undotted(F.col("c"))))
    warning = F.when(visual & ~boxed, "visual_missing_bbox").when(visual & full, "visual_unexpected_content").when(~visual & ~label.isin("table", *PASSED, *NOISE) & full, "unhandled_label")
    return rows.select(*page, F.col("source_index").cast("long").alias("seq"), "y0", md.alias("md"), warning.alias("warning"))


def page_markdown(blocks: DataFrame, page: list[str], stem: Column) -> DataFrame:
    """Markdown of each page's blocks: ordered fragments with extras among them, blank lines between, a newline at the end."""
    extras = unordered_extras(blocks, page, stem).where("md IS NOT NULL")
    merged = G.merge_extras(ordered_fragments(blocks, page), extras.drop("warning"), page)
    return merged.groupBy(*page).agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "md"))), lambda m: m["md"]), "\n\n"), F.lit("\n")).alias("markdown"))


PAGE = ["doc_id", "page"]


def _typeset(spark, sf_dir) -> DataFrame:
    """Whole documents in two columns with line numbers, running headers, sheets, front pages, indents and gaps."""
    at = F.col("ix") % 600
    sheet = F.element_at(F.array(*map(F.lit, ["Sheet", "3", "of", "9"])), F.greatest(F.least(at - 19, F.lit(4)), F.lit(1)).cast("int"))
    word = F.when(F.expr("ix % 12 = 6 AND (ix div 12) % 5 = 4 AND doc_id % 4 <> 1"), F.expr("cast((ix % 600) div 12 + 1 as string)")).when((F.col("doc_id") % 6 == 1) & at.between(20, 23), sheet) \
        .when((F.col("doc_id") % 5 == 3) & (at == 3), "Page").when((F.col("doc_id") % 5 == 3) & (at == 4), "12").otherwise(F.col("word"))
    shift = F.when((F.col("line_no") % 9 == 4) & F.expr("ix % 6 = 0"), 9.0).otherwise(0.0)
    drop = F.when(F.col("line_no") >= 25, 20.0).otherwise(0.0)
    rows = words(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "ix", "page", "line_no", word.alias("word"), (F.col("x0") + shift).alias("x0"), "x1", (F.col("y0") + drop).alias("y0"), (F.col("y0") + drop + 10).alias("y1"))


def _marked(spark, sf_dir):
    return noise(_typeset(spark, sf_dir), *PAGE, 792.0, 612.0)


def noise_words(spark, sf_dir):
    n = lambda words, kind: F.size(F.filter(words, lambda w: w["noise"].eqNullSafe(kind))).cast("long").alias(kind or "kept")
    counts = G.bound(F.col("words"), lambda ws: F.struct(*(n(ws, kind) for kind in ("header_footer", "line_number", None))))
    return _marked(spark, sf_dir).select(*PAGE, "kind", counts.alias("n")).select(*PAGE, "kind", "n.*")


def page_paragraphs(spark, sf_dir):
    return body_paragraphs(_marked(spark, sf_dir), PAGE).select(*PAGE, "col", "para", "lines", "new_by", F.md5("text").alias("digest"))


def composed_bodies(spark, sf_dir):
    return body_texts(body_paragraphs(_marked(spark, sf_dir), PAGE), "doc_id", "page").select("doc_id", F.length("body").alias("n"), F.sha2("body", 256).alias("digest"))


def front_pages(spark, sf_dir):
    return front_texts(_marked(spark, sf_dir), "doc_id", "page").select("doc_id", F.sha2("front", 256).alias("digest"))


def composed_documents(spark, sf_dir):
    """Whole documents from words to Markdown, without a cover; sheets, notices and sections by what they hold."""
    k = F.col("doc_id")
    metas = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("US"), k.cast("string")).alias("number"), F.when(k % 2 == 0, F.concat(F.lit("Title "), k.cast("string"))).alias("title"), F.array(F.lit("A")).alias("inventors"), F.lit("").alias("assignee"), F.lit("").alias("date"), F.array().cast("array<string>").alias("classes"), F.lit("").alias("topic"), F.lit("x.pdf").alias("source"), F.when(k % 3 == 0, "An abstract.").alias("abstract"))
    out = compose_documents(_typeset(spark, sf_dir), metas, "doc_id", "page", 792.0, 612.0)
    return out.select("doc_id", F.regexp_count("markdown", F.lit("(?m)^## Abstract")).alias("abstracts"), F.regexp_count("markdown", F.lit("(?m)^!\\[Drawing Sheet")).alias("sheets"), F.contains("markdown", F.lit("## References Cited")).alias("front"), F.contains("markdown", F.lit(NO_CLAIMS)).alias("notice"), F.contains("markdown", F.lit("\n# Title")).alias("titled"))


def reading_targets(spark, sf_dir):
    """Pages of documents to recognise anew, where some have no words, some are asked for, and some words are garbled."""
    rows = _typeset(spark, sf_dir)
    pages = rows.select(*PAGE).distinct()
    rows = rows.where("(doc_id + page) % 7 <> 3").withColumn("word", F.when((F.col("doc_id") % 5 == 2) & (F.col("ix") % 600 == 77), "2002fO116029").otherwise(F.col("word")))
    kinds = G.page_kinds(rows, ["doc_id"], "page", 612.0)
    known = rows.select(F.lower("word").alias("word")).where("false")
    return pages_to_read(pages, rows, kinds, known, pages.where("doc_id % 11 = 4 AND page < 2").unionByName(pages.where("doc_id = 0").withColumn("page", F.col("page") + 1000)), PAGE)


def column_retries(spark, sf_dir):
    """Heights of words, of which some pages have many twice as high; a dictionary of words that occur in five places."""
    rows = _typeset(spark, sf_dir)
    tall = F.when((F.col("doc_id") % 3 == 0) & (F.col("ix") % 5 < 3), 9.0).when(F.col("ix") % 40 == 1, 9.0).otherwise(0.0)
    rows = rows.withColumn("y1", F.col("y1") + tall)
    core = F.lower(F.regexp_replace("word", r"^[^\p{L}]+|[^\p{L}]+$", ""))
    known = rows.select(core.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 5 AND word <> ''").select("word")
    return column_retry(rows, known, PAGE)


def ladder_bands(spark, sf_dir):
    return ladder_band(_typeset(spark, sf_dir), PAGE, 612.0)


def _blocks(spark, sf_dir) -> DataFrame:
    """Turns as blocks of pages of six: all labels, whole texts, some blank, some without an order or a place."""
    t = table(spark, sf_dir, "conversations")
    labels = ["text", "display_formula", "formula_number", "paragraph_title", "content", "doc_title", "image", "vision_footnote", "footnote", "header", "algorithm", "odd"]
    k = F.length("text")
    label = F.element_at(F.array(*map(F.lit, labels)), ((k + F.col("turn")) % 12 + 1).cast("int"))
    content = F.when(k % 17 == 0, " ").when(label == "formula_number", F.concat(F.lit("("), F.col("turn").cast("string"), F.lit(".5)"))).when(label == "vision_footnote", F.concat(F.lit("note "), (F.col("turn") % 2).cast("string"))).otherwise(F.regexp_replace(F.translate("text", "$\\{}`&", "§/()'+"), r"\s+", " "))
    loose = label.isin("image", "vision_footnote", "footnote", "header", "odd")
    return t.select("conv_id", F.expr("cast(turn div 6 as int)").alias("page"), (F.col("turn") % 6).cast("int").alias("source_index"), F.col("turn").cast("int").alias("block_id"), label.alias("label"), content.alias("content"), F.when(~loose, F.col("turn")).alias("block_order"), F.when(k % 5 != 0, (k * 7 % 50).cast("double")).alias("y0"))


def page_fragments(spark, sf_dir):
    return ordered_fragments(_blocks(spark, sf_dir), ["conv_id", "page"]).select("conv_id", "page", "pos", F.md5("md").alias("digest"))


def page_extras(spark, sf_dir):
    return unordered_extras(_blocks(spark, sf_dir), ["conv_id", "page"], F.lit("doc")).select("conv_id", "page", "seq", F.md5("md").alias("digest"), "warning")


def page_texts(spark, sf_dir):
    return page_markdown(_blocks(spark, sf_dir), ["conv_id", "page"], F.lit("doc")).select("conv_id", "page", F.length("markdown").alias("n"), F.md5("markdown").alias("digest"))


QUERIES = {f.__name__: f for f in (noise_words, page_paragraphs, composed_bodies, front_pages, composed_documents, reading_targets, column_retries, ladder_bands, page_fragments, page_extras, page_texts)}

_SET = "WITH " + WORDS + r""", v AS (SELECT doc_id, ix, page, line_no, CASE WHEN ix % 12 = 6 AND (ix // 12) % 5 = 4 AND doc_id % 4 <> 1 THEN CAST((ix % 600) // 12 + 1 AS VARCHAR) WHEN doc_id % 6 = 1 AND ix % 600 BETWEEN 20 AND 23 THEN (['Sheet', '3', 'of', '9'])[ix % 600 - 19]
   WHEN doc_id % 5 = 3 AND ix % 600 = 3 THEN 'Page' WHEN doc_id % 5 = 3 AND ix % 600 = 4 THEN '12' ELSE word END AS word, x0 + CASE WHEN line_no % 9 = 4 AND ix % 6 = 0 THEN 9.0 ELSE 0.0 END AS x0, x1, y0 + CASE WHEN line_no >= 25 THEN 20.0 ELSE 0.0 END AS y0 FROM words)"""
_KINDS = _SET + r""", c AS (SELECT *, (x0 + x1) / 2 AS xc, row_number() OVER (PARTITION BY doc_id, page ORDER BY ix) AS place FROM v),
 m AS (SELECT *, regexp_full_match(word, '[0-9]{1,9}') AND TRY_CAST(word AS INTEGER) % 5 = 0 AND TRY_CAST(word AS INTEGER) BETWEEN 5 AND 70 AND abs(xc - 306) <= 35 AS rung FROM c),
 gt AS (SELECT doc_id, page, coalesce(median(CAST(xc AS DOUBLE)) FILTER (rung), 306.0) AS gutter FROM m GROUP BY ALL),
 ks AS (SELECT doc_id, page, gutter, count(*) AS n, count(*) FILTER (rung) AS ladder, count(*) FILTER (xc < gutter - 20) AS l, count(*) FILTER (xc > gutter + 20) AS r, string_agg(word, ' ' ORDER BY ix) FILTER (place <= 15) AS head, string_agg(word, ' ' ORDER BY ix) AS t FROM m JOIN gt USING (doc_id, page) GROUP BY ALL),
 kd AS (SELECT doc_id, page, gutter, CASE WHEN page = 0 THEN 'COVER' WHEN regexp_matches(head, '\bPage\s+[0-9]') THEN 'FRONT_MATTER' WHEN ladder >= 6 OR (ladder >= 2 AND l >= 80 AND r >= 80) THEN 'SPEC_BODY' WHEN regexp_matches(t, 'Sheet\s+[0-9]+\s+[Oo]f\s+[0-9]+') OR n < 150 THEN 'FIGURE' ELSE 'FRONT_MATTER' END AS kind FROM ks)"""
_SEP = r"""CASE WHEN b IS NULL OR word IN (',', '.', ';', ':', '!', '?', ')', ']', '}', '%', '’', '”', chr(39), '"', '°', '/', '-') OR b IN ('(', '[', '{', '“', '‘', '$', '/', '-') THEN '' WHEN b IN (',', ';') AND regexp_matches(word, '^\p{L}') THEN ' '
   WHEN (regexp_full_match(word, '[^\p{L}\p{N}]') OR regexp_full_match(b, '[^\p{L}\p{N}]')) AND NOT x0 - bx > """
_NOISE = _KINDS + r""", z AS (SELECT *, CASE WHEN y0 + 5 < 0.11 * 792 THEN 'head' WHEN y0 + 5 > 0.92 * 792 THEN 'foot' END AS zone FROM c),
 zl AS (SELECT *, lag(word) OVER o AS b, lag(x1) OVER o AS bx FROM z WHERE zone IS NOT NULL WINDOW o AS (PARTITION BY doc_id, page, line_no ORDER BY x0, ix)),
 zt AS (SELECT doc_id, page, line_no, trim(string_agg(""" + _SEP + r"""2.0 THEN '' ELSE ' ' END || word, '' ORDER BY x0, ix), ' ') AS t FROM zl GROUP BY ALL),
 bad AS (SELECT * FROM zt WHERE regexp_matches(t, '(?i)(U\.?\s*S\.?\s*Patent|US\s*[0-9,]+\s*B[12]|Sheet\s+[0-9]+\s+of\s+[0-9]+|^US0?[0-9]{6,}|\bPage\s+[0-9]+)') OR regexp_full_match(t, '[0-9]{1,4}\.?(\s+[0-9]{1,4}\.?)?')),
 nz AS (SELECT z.*, kind, gutter, CASE WHEN bad.t IS NOT NULL AND zone IS NOT NULL THEN 'header_footer' WHEN kind = 'SPEC_BODY' AND regexp_full_match(word, '\p{Nd}+') AND abs(xc - gutter) <= 8 THEN 'line_number' END AS noise FROM z JOIN kd USING (doc_id, page) LEFT JOIN bad USING (doc_id, page, line_no))"""
_MED = r"coalesce(median(CASE WHEN regexp_full_match(word, '\p{L}{3,}') THEN CAST(x1 - x0 AS DOUBLE) / length(word) END), 6.0)"
_PARAS = _NOISE + r""", bd AS (SELECT *, CASE WHEN xc < gutter THEN 'L' ELSE 'R' END AS col FROM nz WHERE kind = 'SPEC_BODY' AND noise IS NULL),
 pw AS (SELECT doc_id, page, """ + _MED + r""" AS cw FROM bd GROUP BY ALL), cwd AS (SELECT doc_id, page, col, """ + _MED + r""" AS ccw FROM bd GROUP BY ALL),
 bl AS (SELECT *, lag(word) OVER o AS b, lag(x1) OVER o AS bx FROM bd JOIN pw USING (doc_id, page) WINDOW o AS (PARTITION BY doc_id, page, col, line_no ORDER BY x0, ix)),
 ln AS (SELECT doc_id, page, col, line_no, string_agg(""" + _SEP + r"""greatest(1.5, 0.55 * cw) THEN '' ELSE ' ' END || word, '' ORDER BY x0, ix) AS text, min(x0) AS x0, min(y0) AS y FROM bl GROUP BY ALL),
 mg AS (SELECT doc_id, page, col, list_sort(list(x0))[count(*) // 10 + 1] AS margin FROM ln GROUP BY ALL),
 nn AS (SELECT ln.*, CASE WHEN x0 > margin + greatest(2.5, ccw) THEN 'indent' WHEN y - lag(y) OVER w > 17 THEN 'gap' WHEN lag(y) OVER w IS NULL THEN 'first' END AS by_ FROM ln JOIN mg USING (doc_id, page, col) JOIN cwd USING (doc_id, page, col) WINDOW w AS (PARTITION BY doc_id, page, col ORDER BY line_no)),
 pp AS (SELECT *, CAST(count(by_) OVER (PARTITION BY doc_id, page, col ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS para FROM nn),
 qq AS (SELECT *, coalesce(by_ IS NULL AND regexp_matches(lag(text) OVER w, '\p{L}-$') AND regexp_matches(text, '^\p{Ll}'), false) AS soft FROM pp WINDOW w AS (PARTITION BY doc_id, page, col ORDER BY line_no)),
 rr AS (SELECT *, coalesce(lead(soft) OVER (PARTITION BY doc_id, page, col ORDER BY line_no), false) AS cut FROM qq),
 pa AS (SELECT doc_id, page, col, para, string_agg(CASE WHEN soft OR by_ IS NOT NULL THEN '' ELSE ' ' END || CASE WHEN cut THEN text[:-2] ELSE text END, '' ORDER BY line_no) AS text, count(*) AS lines, max(by_) AS new_by FROM rr GROUP BY ALL)"""
_BLK = r"""WITH t AS (SELECT *, length(text) AS k, (['text', 'display_formula', 'formula_number', 'paragraph_title', 'content', 'doc_title', 'image', 'vision_footnote', 'footnote', 'header', 'algorithm', 'odd'])[(length(text) + turn) % 12 + 1] AS label FROM conversations),
 b AS (SELECT conv_id, CAST(turn // 6 AS INTEGER) AS page, turn % 6 AS si, turn, label, trim(CASE WHEN k % 17 = 0 THEN ' ' WHEN label = 'formula_number' THEN '(' || turn || '.5)' WHEN label = 'vision_footnote' THEN 'note ' || turn % 2 ELSE regexp_replace(translate(text, '$\{}`&', '§/()''+'), '\s+', ' ', 'g') END, ' ') AS c,
  label IN ('image', 'vision_footnote', 'footnote', 'header', 'odd') AS loose, CASE WHEN k % 5 <> 0 THEN CAST(k * 7 % 50 AS DOUBLE) END AS y0 FROM t),
 o AS (SELECT *, row_number() OVER w AS pos, lead(label) OVER w AS nl, lead(c) OVER w AS nc, lag(label) OVER w AS pl, lag(c) OVER w AS pc, bool_or(label = 'paragraph_title') OVER (PARTITION BY conv_id, page) AS titled FROM b WHERE NOT loose WINDOW w AS (PARTITION BY conv_id, page ORDER BY turn)),
 fr AS (SELECT conv_id, page, CAST(pos AS INTEGER) AS pos, coalesce(y0, 0.0) AS y0, CASE WHEN label = 'paragraph_title' OR (label = 'doc_title' AND titled) THEN '## ' || c WHEN label = 'algorithm' THEN '```' || chr(10) || c || chr(10) || '```' WHEN label = 'display_formula' AND nl = 'formula_number' THEN '$$ ' || c || ' \tag{' || replace(replace(nc, '(', ''), ')', '') || '} $$'
   WHEN label = 'display_formula' THEN '$$ ' || c || ' $$' ELSE c END AS md FROM o WHERE c <> '' AND NOT coalesce(label = 'formula_number' AND pl = 'display_formula' AND pc <> '', false)),
 td AS (SELECT conv_id, page, regexp_replace(string_agg(c, chr(10) ORDER BY si), '\s+', ' ', 'g') AS told FROM b WHERE NOT loose GROUP BY ALL),
 lo AS (SELECT b.*, label = 'vision_footnote' AND c <> '' AND (row_number() OVER (PARTITION BY b.conv_id, b.page, label, c ORDER BY si) > 1 OR coalesce(contains(told, c), false)) AS again FROM b LEFT JOIN td USING (conv_id, page) WHERE loose),
 ex AS (SELECT conv_id, page, si AS seq, y0, CASE WHEN label = 'image' THEN CASE WHEN y0 IS NOT NULL THEN '![](doc.assets/' || printf('page_%04d_block_%d.png', page, turn) || ')' || CASE WHEN c <> '' THEN chr(10) || chr(10) || c ELSE '' END END WHEN label IN ('vision_footnote', 'footnote') AND c <> '' AND NOT again THEN c END AS md,
   CASE WHEN label = 'image' AND y0 IS NULL THEN 'visual_missing_bbox' WHEN label = 'image' AND c <> '' THEN 'visual_unexpected_content' WHEN label = 'odd' AND c <> '' THEN 'unhandled_label' END AS warning FROM lo)"""
ORACLE = {
    "noise_words": _NOISE + " SELECT doc_id, page, kind, count(*) FILTER (noise = 'header_footer') AS header_footer, count(*) FILTER (noise = 'line_number') AS line_number, count(*) FILTER (noise IS NULL) AS kept FROM nz GROUP BY ALL",
    "page_paragraphs": _PARAS + " SELECT doc_id, page, col, para, lines, new_by, md5(text) AS digest FROM pa",
    "composed_bodies": _PARAS + r""", bb AS (SELECT *, regexp_replace(lag(text) OVER (PARTITION BY doc_id ORDER BY page, col, para), '[’”"'')\]\s]+$', '') AS bare FROM pa),
 nw AS (SELECT *, CASE WHEN new_by = 'first' AND bare <> '' AND bare[-1] NOT IN ('.', '!', '?', ':') AND regexp_matches(text, '^[^\p{L}]*\p{Ll}') THEN 0 ELSE 1 END AS new FROM bb),
 mm AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY page, col, para) AS merged, coalesce(lead(new) OVER (PARTITION BY doc_id ORDER BY page, col, para), 1) AS last FROM nw),
 tt AS (SELECT doc_id, merged, trim(string_agg(CASE WHEN new = 0 AND last = 0 THEN trim(text, ' ') WHEN new = 0 THEN ltrim(text, ' ') WHEN last = 0 THEN rtrim(text, ' ') ELSE text END, ' ' ORDER BY page, col, para), ' ') AS text FROM mm GROUP BY ALL),
 dd AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY merged) AS body FROM tt WHERE text <> '' GROUP BY doc_id) SELECT doc_id, CAST(length(body) AS INTEGER) AS n, sha256(body) AS digest FROM dd""",
    "front_pages": _NOISE + r""", bd AS (SELECT * FROM nz WHERE kind = 'FRONT_MATTER' AND noise IS NULL), pw AS (SELECT doc_id, page, """ + _MED + r""" AS cw FROM bd GROUP BY ALL),
 bl AS (SELECT *, lag(word) OVER o AS b, lag(x1) OVER o AS bx FROM bd JOIN pw USING (doc_id, page) WINDOW o AS (PARTITION BY doc_id, page, line_no ORDER BY x0, ix)),
 ln AS (SELECT doc_id, page, line_no, string_agg(""" + _SEP + r"""greatest(1.5, 0.55 * cw) THEN '' ELSE ' ' END || word, '' ORDER BY x0, ix) AS text FROM bl GROUP BY ALL), pt AS (SELECT doc_id, page, string_agg(text, chr(10) ORDER BY line_no) AS t FROM ln GROUP BY ALL)
 SELECT doc_id, sha256(string_agg(t, chr(10) || chr(10) ORDER BY page)) AS digest FROM pt GROUP BY doc_id""",
    "composed_documents": _NOISE + r""", s AS (SELECT doc_id, count(DISTINCT page) FILTER (kind = 'FIGURE') AS sheets, bool_or(kind = 'FRONT_MATTER' AND noise IS NULL) AS front, bool_or(kind = 'SPEC_BODY' AND noise IS NULL) AS body FROM nz GROUP BY doc_id)
 SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN 1 ELSE 0 END AS abstracts, CAST(coalesce(sheets, 0) AS INTEGER) AS sheets, coalesce(front, false) AS front, coalesce(body, false) AS notice, d.doc_id % 2 = 0 AS titled FROM documents d LEFT JOIN s USING (doc_id)""",
    "reading_targets": None,
    "column_retries": None,
    "ladder_bands": _SET + """, r AS (SELECT *, regexp_full_match(word, '[0-9]{1,9}') AND TRY_CAST(word AS INTEGER) % 5 = 0 AND TRY_CAST(word AS INTEGER) BETWEEN 1 AND 80 AND (x0 + x1) / 2 BETWEEN 204 AND 408 AS rung FROM v)
 SELECT doc_id, page, round(CAST(coalesce(min(x0) FILTER (rung), 306) AS DOUBLE) - 3, 1) AS lo, round(CAST(coalesce(max(x1) FILTER (rung), 306) AS DOUBLE) + 3, 1) AS hi FROM r GROUP BY ALL""",
    "page_fragments": _BLK + " SELECT conv_id, page, pos, md5(md) AS digest FROM fr",
    "page_extras": _BLK + " SELECT conv_id, page, seq, md5(md) AS digest, warning FROM ex",
    "page_texts": _BLK + """, pl AS (SELECT ex.*, coalesce((SELECT min(pos) FROM fr WHERE fr.conv_id = ex.conv_id AND fr.page = ex.page AND fr.y0 > ex.y0), 2147483647) AS slot FROM ex WHERE md IS NOT NULL),
 u AS (SELECT conv_id, page, pos AS slot, 1 AS k, 0 AS tail, y0, 0 AS seq, md FROM fr UNION ALL SELECT conv_id, page, slot, 0, CASE WHEN y0 IS NULL THEN 1 ELSE 0 END, y0, seq, md FROM pl),
 j AS (SELECT conv_id, page, string_agg(md, chr(10) || chr(10) ORDER BY slot, k, tail, y0 NULLS LAST, seq) || chr(10) AS markdown FROM u GROUP BY ALL) SELECT conv_id, page, CAST(length(markdown) AS INTEGER) AS n, md5(markdown) AS digest FROM j""",
}
ORACLE["reading_targets"] = _SET + r""", pg AS (SELECT DISTINCT doc_id, page FROM v), w AS (SELECT * REPLACE (CASE WHEN doc_id % 5 = 2 AND ix % 600 = 77 THEN '2002fO116029' ELSE word END AS word) FROM v WHERE (doc_id + page) % 7 <> 3)""" + _KINDS[len(_SET):].replace("FROM v)", "FROM w)") + r""",
 g AS (SELECT DISTINCT doc_id, page FROM (SELECT *, regexp_replace(word, '^[^0-9A-Za-z]+|[^0-9A-Za-z]+$', '', 'g') AS core FROM w) JOIN kd USING (doc_id, page) WHERE kind = 'SPEC_BODY' AND length(core) >= 2 AND (regexp_matches(core, '[0-9]{4}[A-Za-z]{1,2}[0-9]{4,}')
   OR (regexp_full_match(core, '\p{L}+') AND NOT regexp_full_match(core, '([A-Z][a-z]+)+') AND core <> upper(core) AND NOT regexp_full_match(core, '[a-z]{1,2}[A-Z]{2,}') AND regexp_matches(core, '[^A-Z][A-Z]{2,}'))))
 SELECT doc_id, page FROM pg WHERE (doc_id + page) % 7 = 3 UNION SELECT doc_id, page FROM pg WHERE doc_id % 11 = 4 AND page < 2 UNION SELECT doc_id, page FROM g"""
ORACLE["column_retries"] = _SET + r""", h AS (SELECT *, 10.0 + CASE WHEN doc_id % 3 = 0 AND ix % 5 < 3 THEN 9.0 WHEN ix % 40 = 1 THEN 9.0 ELSE 0.0 END AS h, lower(regexp_replace(word, '^[^\p{L}]+|[^\p{L}]+$', '', 'g')) AS core FROM v),
 d AS (SELECT core FROM h WHERE core <> '' GROUP BY core HAVING count(*) >= 5), s AS (SELECT doc_id, page, list_sort(list(CAST(h AS DOUBLE))) AS hs FROM h GROUP BY ALL), p AS (SELECT doc_id, page, len(hs) AS n, hs[len(hs) // 10 + 1] AS p10, hs[len(hs) // 2 + 1] AS p50 FROM s),
 o AS (SELECT h.doc_id, h.page, count(*) AS c FROM h JOIN p USING (doc_id, page) WHERE h >= 1.6 * p10 AND core <> '' AND core NOT IN (SELECT core FROM d) GROUP BY ALL)
 SELECT doc_id, page, p10, p50, CAST(CASE WHEN n >= 5 THEN coalesce(c, 0) ELSE 0 END AS BIGINT) AS suspects, p50 / p10 >= 1.3 AND n >= 5 AND coalesce(c, 0) >= 2 AS retry FROM p LEFT JOIN o USING (doc_id, page)"""
