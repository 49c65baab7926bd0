"""Words on pages: bands, columns, page kinds, lines, paragraphs, and words, points and extras matched to blocks."""

from __future__ import annotations

from bisect import insort
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.sources.tables import WORDS, table, words

#: Fixed values of the layout: bands of the page height, ladder of line numbers, columns.
HEADER, FOOTER = 0.11, 0.92
LADDER, LADDER_WEAK, LADDER_TOP, LADDER_HALF = 6, 2, 70, 35.0
COLUMN_WORDS, FIGURE_WORDS, GUTTER = 80, 150, 8.0
RUNNING_HEADER = r"(?i)(U\.?\s*S\.?\s*Patent|US\s*[\d,]+\s*B[12]|Sheet\s+\d+\s+of\s+\d+|^US0?\d{6,}|\bPage\s+\d+)"
NUMBER_ROW = r"^[0-9]{1,4}\.?(?:\s+[0-9]{1,4}\.?)?$"
SHEET = r"Sheet\s+[0-9]+\s+[Oo]f\s+[0-9]+"
#: One-character tokens that lean left or right, line tolerance, paragraph and space thresholds.
CLOSE, OPEN = r"^[,.;:!?)\]}%’”'\"°]$", r"^[(\[{“‘$]$"
MARK = r"^[^\p{L}\p{N}]$"
LINE_SHARE, GAP_SHARE, INDENT, SPACE, SPACE_SHARE, BAND_SPACE = 0.30, 1.7, 2.5, 1.5, 0.55, 2.0


#: A page's words as one array, in any order; all that is told of a page is told in its one row, so nothing else is shuffled.
WORD = ("ix", "word", "x0", "y0", "x1", "y1")


def packed_words() -> Column:
    return F.collect_list(F.struct(*WORD))


def bound(value: Column, f) -> Column:
    """f of a value that is computed once, though f reads it in a function of many elements."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def centre(w: Column) -> Column:
    return (w["y0"] + w["y1"]) / 2


def in_lines(pages: DataFrame, arrays: dict[str, str], tolerance: Column) -> DataFrame:
    """Adds, for each array of words (name: new name), its lines as arrays of words by place: those of group_lines()."""

    @F.arrow_udf("array<struct<at: int, n: int>>")
    def runs(centres: pa.Array, tolerances: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
        return by_slices(lambda ys, t: line_runs(ys, t), kind, centres, tolerances)

    rising = lambda c: F.transform(F.sort_array(F.transform(c, lambda w: F.struct(centre(w).alias("y"), w["ix"].alias("ix"), w.alias("w")))), lambda x: x["w"])
    pages = pages.select("*", *(rising(F.col(a)).alias(f"_r_{b}") for a, b in arrays.items()))
    pages = pages.select("*", *(runs(F.transform(f"_r_{b}", centre), tolerance.cast("double")).alias(f"_n_{b}") for b in arrays.values()))
    by_place = lambda c: F.transform(F.sort_array(F.transform(c, lambda w: F.struct(w["x0"].alias("x"), w["ix"].alias("ix"), w.alias("w")))), lambda x: x["w"])
    lines = lambda b: F.transform(f"_n_{b}", lambda r: by_place(F.slice(F.col(f"_r_{b}"), r["at"] + 1, r["n"])))
    return pages.select("*", *(lines(b).alias(b) for b in arrays.values())).drop(*(f"_{k}_{b}" for k in "rn" for b in arrays.values()))


def line_text(line: Column, threshold: Column) -> Column:
    """A line's words, in order of place, with the separators of space_between()."""
    return F.array_join(F.transform(line, lambda w, i: F.concat(space_between(w["word"], F.get(line, i - 1)["word"], w["x0"] - F.get(line, i - 1)["x1"], threshold), w["word"])), "")


def strip_bands(pages: DataFrame, height: float, header: str = RUNNING_HEADER) -> DataFrame:
    """Of pages with `words` and their median height `_h`: adds `removed`, the ix of the words of whole lines of the header and footer zones
    that look like running headers or number rows.

    Lines are those of group_lines inside a zone, with a tolerance of 0.30 of the page's median word height.
    """
    zones = pages.select("*", F.filter("words", lambda w: centre(w) < HEADER * height).alias("_head"), F.filter("words", lambda w: (centre(w) > FOOTER * height) & ~(centre(w) < HEADER * height)).alias("_foot"))
    zones = in_lines(zones, {"_head": "_hl", "_foot": "_fl"}, F.col("_h") * LINE_SHARE)
    told = F.transform(F.concat("_hl", "_fl"), lambda line: F.struct(F.trim(line_text(line, F.lit(BAND_SPACE))).alias("t"), F.transform(line, lambda w: w["ix"]).alias("ix")))
    bad = F.filter(told, lambda x: x["t"].rlike(header) | x["t"].rlike(NUMBER_ROW))
    return zones.withColumn("removed", F.flatten(F.transform(bad, lambda x: x["ix"]))).drop("_head", "_foot", "_hl", "_fl")


def is_line_number(word: Column, xc: Column, gutter: Column) -> Column:
    return word.rlike(r"^\p{Nd}+$") & (F.abs(xc - gutter) <= GUTTER)


def column_of(xc: Column, gutter: Column) -> Column:
    return F.when(xc < gutter, "L").otherwise("R")


def page_kinds(df: DataFrame, page: list[str], index: str, width: float, *more: Column) -> DataFrame:
    """Ordered page rule over word counts, the ladder of line numbers and the page's text.

    The gutter is the median centre of the ladder, else the page's centre; ladder_x holds the ladder's centres in order. more:
    aggregates to be had in the same pass.
    """
    xc = (F.col("x0") + F.col("x1")) / 2
    centre = F.lit(width / 2)
    number = F.when(F.col("word").rlike("^[0-9]{1,9}$"), F.col("word").cast("int"))
    ladder = (number % 5 == 0) & number.between(5, LADDER_TOP) & (F.abs(xc - centre) <= LADDER_HALF)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("ix", "word"))), lambda s: s["word"])
    sums = df.groupBy(*page, index).agg(F.count(F.lit(1)).cast("long").alias("n"), F.sort_array(F.collect_list(F.when(ladder, xc))).alias("ladder_x"), F.median(F.when(ladder, xc)).alias("_g"), F.collect_list(xc).alias("_x"), ordered.alias("_w"), *more)
    names = [c for c in sums.columns if c not in (*page, index, "n", "ladder_x", "_g", "_x", "_w")]
    sums = sums.withColumn("ladder", F.size("ladder_x").cast("long")).withColumn("gutter", F.coalesce("_g", centre)).withColumn("_t", F.array_join("_w", " "))
    beside = lambda f: F.size(F.filter("_x", f)) >= COLUMN_WORDS
    body = (F.col("ladder") >= LADDER) | ((F.col("ladder") >= LADDER_WEAK) & beside(lambda x: x < F.col("gutter") - 20) & beside(lambda x: x > F.col("gutter") + 20))
    front = F.array_join(F.slice("_w", 1, 15), " ").rlike(r"\bPage\s+\p{Nd}")
    kind = F.when(F.col(index) == 0, "COVER").when(front, "FRONT_MATTER").when(body, "SPEC_BODY").when(F.col("_t").rlike(SHEET) | (F.col("n") < FIGURE_WORDS), "FIGURE").otherwise("FRONT_MATTER")
    return sums.select(*page, index, "n", "ladder", "ladder_x", "gutter", kind.alias("kind"), *names)


def medians(df: DataFrame, page: list[str]) -> DataFrame:
    """Exact medians of character width (letters only, three or more) and of height, with defaults 6 and 10."""
    wide = F.when(F.col("word").rlike(LETTERS), (F.col("x1") - F.col("x0")) / F.length("word"))
    return df.groupBy(*page).agg(F.coalesce(F.median(wide), F.lit(6.0)).alias("char_width"), median_height().alias("height"))


#: Fixed value: words whose width tells that of a character.
LETTERS = r"^\p{L}{3,}$"


def median_height() -> Column:
    return F.coalesce(F.median(F.when(F.col("y1") > F.col("y0"), F.col("y1") - F.col("y0"))), F.lit(10.0))


def middle(xs: Column) -> Column:
    """Exact median of an array."""
    half = lambda s, k: F.get(s, F.floor((F.size(s) - k) / 2).cast("int"))
    return bound(F.sort_array(xs), lambda s: (half(s, 1) + half(s, 0)) / 2)


def char_width(ws: Column) -> Column:
    """That of medians(), of an array of words."""
    return F.coalesce(middle(F.transform(F.filter(ws, lambda w: w["word"].rlike(LETTERS)), lambda w: (w["x1"] - w["x0"]) / F.length(w["word"]))), F.lit(6.0))


def word_height(ws: Column) -> Column:
    """That of medians(), of an array of words."""
    return F.coalesce(middle(F.transform(F.filter(ws, lambda w: w["y1"] > w["y0"]), lambda w: w["y1"] - w["y0"])), F.lit(10.0))


def height_split(df: DataFrame, page: list[str], height: Column) -> DataFrame:
    """Heights at index n/10 and n/2 of their sorted order (not interpolated), and whether they are bimodal."""
    h = F.sort_array(F.collect_list(height))
    out = df.groupBy(*page).agg(h.alias("h")).withColumn("p10", F.element_at("h", F.expr("cast(size(h) div 10 + 1 as int)"))).withColumn("p50", F.element_at("h", F.expr("cast(size(h) div 2 + 1 as int)")))
    return out.select(*page, "p10", "p50", (F.col("p50") / F.col("p10") >= 1.3).alias("bimodal"), F.size(F.filter("h", lambda x: x >= F.col("p10") * 1.6)).alias("tall"))


def line_numbers(centres: list[float], tolerance: float) -> list[int]:
    """Line of each word, given by their centres in rising order: a word joins the line while it is near its running median."""
    line, ys, out = -1, [], []
    for y in centres:
        middle = None if not ys else (ys[(len(ys) - 1) // 2] + ys[len(ys) // 2]) / 2
        if middle is None or abs(y - middle) > tolerance:
            line, ys = line + 1, []
        insort(ys, y)
        out.append(line)
    return out


def line_runs(centres: list[float], tolerance: float) -> list[dict]:
    """Where each line of line_numbers() starts, and how many words it has."""
    out: list[dict] = []
    for i, line in enumerate(line_numbers(centres, tolerance)):
        if line == len(out):
            out.append({"at": i, "n": 0})
        out[-1]["n"] += 1
    return out


def by_slices(f, kind: pa.DataType, *columns: pa.Array, rows: int = 256) -> pa.Array:
    """f of each row, a few rows at a time as Python objects, so that a batch of whole pages stays in Arrow's memory."""
    parts = [pa.array([f(*x) for x in zip(*(c.slice(i, rows).to_pylist() for c in columns), strict=True)], kind) for i in range(0, len(columns[0]), rows)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def group_lines(df: DataFrame, page: list[str], tolerance: Column) -> DataFrame:
    """Line number of each word of a page, ties in height by ix.

    The fold depends on order, so a page's words, which are bounded, are one row while it runs; many pages share an Arrow batch.
    """

    @F.arrow_udf("array<int>")
    def numbered(centres: pa.Array, tolerances: pa.Array) -> pa.Array:
        return by_slices(line_numbers, pa.list_(pa.int32()), centres, tolerances)

    word = F.struct(((F.col("y0") + F.col("y1")) / 2).alias("yc"), "ix")
    pages = df.groupBy(*page).agg(F.sort_array(F.collect_list(word)).alias("_w"), F.first(tolerance.cast("double")).alias("_tol"))
    lined = pages.select(*page, F.arrays_zip(F.col("_w.ix").alias("ix"), numbered(F.col("_w.yc"), F.col("_tol")).alias("line")).alias("_l"))
    return lined.select(*page, F.inline("_l"))


def space_between(word: Column, before: Column, gap: Column, threshold: Column) -> Column:
    """Separator before a word. One-character tokens decide: none before a closing or after an opening one, nor at a slash or
    hyphen; a blank between a comma or semicolon and a letter; other marks go by the gap; two words always have a blank."""
    none = before.isNull() | word.rlike(CLOSE) | before.rlike(OPEN) | word.isin("/", "-") | before.isin("/", "-")
    pause = before.isin(",", ";") & word.rlike(r"^\p{L}")
    mark = word.rlike(MARK) | before.rlike(MARK)
    return F.when(none, "").when(pause, " ").when(mark & ~(gap > threshold), "").otherwise(" ")


def join_lines(df: DataFrame, line: list[str], threshold: Column) -> DataFrame:
    w = Window.partitionBy(*line).orderBy("x0", "ix")
    rows = df.withColumn("_s", space_between(F.col("word"), F.lag("word").over(w), F.col("x0") - F.lag("x1").over(w), threshold))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("x0", "ix", F.concat("_s", "word").alias("t")))), lambda s: s["t"])
    return rows.groupBy(*line).agg(F.array_join(parts, "").alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"))


def paragraphs(lines: DataFrame, key: list[str], char_width: Column, line_height: Column) -> DataFrame:
    """Lines (line_no, x0, y, text) joined to paragraphs: para, text, lines, new_by.

    A paragraph starts at an indent of more than max(2.5, a character) past the index-decile margin, or after a gap of more
    than 1.7 line heights. A line that ends in a letter and a hyphen joins the next without either where that one begins in
    lower case.
    """
    w = Window.partitionBy(*key).orderBy("line_no")
    lines = lines.withColumn("_m", F.sort_array(F.collect_list("x0").over(Window.partitionBy(*key)))).withColumn("_margin", F.element_at("_m", F.expr("cast(size(_m) div 10 + 1 as int)"))).drop("_m")
    indent = F.col("x0") > F.col("_margin") + F.greatest(F.lit(INDENT), char_width)
    gap = F.coalesce(F.col("y") - F.lag("y").over(w) > GAP_SHARE * line_height, F.lit(False))
    rows = lines.withColumn("_by", F.when(indent, "indent").when(gap, "gap").when(F.lag("y").over(w).isNull(), "first"))
    rows = rows.withColumn("para", F.sum(F.when(F.col("_by").isNotNull(), 1).otherwise(0)).over(w))
    soft = (F.lag("para").over(w) == F.col("para")) & F.lag("text").over(w).rlike(r"\p{L}-$") & F.col("text").rlike(r"^\p{Ll}")
    rows = rows.withColumn("_soft", F.coalesce(soft, F.lit(False)))
    cut = F.when(F.coalesce(F.lead("_soft").over(w), F.lit(False)), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    start = F.lag("para").over(w).isNull() | (F.lag("para").over(w) != F.col("para"))
    rows = rows.withColumn("_t", F.concat(F.when(F.col("_soft") | start, "").otherwise(" "), cut))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("line_no", "_t"))), lambda s: s["_t"])
    return rows.groupBy(*key, "para").agg(F.array_join(parts, "").alias("text"), F.count(F.lit(1)).alias("lines"), F.max("_by").alias("new_by"))


#: Marks that end a sentence, and those that may follow them.
SENTENCE_END = r"[.!?:][’”\"')\]\s]*$"
ALL_CLOSERS = r"^[’”\"')\]\s]*$"


def merge_continuations(paras: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Joins a paragraph to the one before where it begins a column or page (new_by = first) in lower case and the one before
    is left open, closing quotes and brackets aside."""
    w = Window.partitionBy(*key).orderBy(*order)
    before = F.lag("text").over(w)
    is_open = ~before.rlike(SENTENCE_END) & ~before.rlike(ALL_CLOSERS)
    lower = F.regexp_extract("text", r"^[^\p{L}]*(\p{L})", 1).rlike(r"^\p{Ll}")
    rows = paras.withColumn("_new", F.when((F.col("new_by") == "first") & is_open & lower, 0).otherwise(1)).withColumn("merged", F.sum("_new").over(w))
    rows = rows.withColumn("_end", F.lead("merged").over(w))
    text = F.when(F.col("_new") == 0, F.ltrim("text")).otherwise(F.col("text"))
    text = F.when(F.col("_end") == F.col("merged"), F.rtrim(text)).otherwise(text)
    parts = F.transform(F.sort_array(F.collect_list(F.struct(*order, text.alias("_t")))), lambda s: s["_t"])
    return rows.groupBy(*key, "merged").agg(F.array_join(parts, " ").alias("text"), F.count(F.lit(1)).alias("pieces"))


def meeting(page: list[str], **frames: tuple[DataFrame, Column]) -> DataFrame:
    """One row a page with what each frame says of it, as a list (name: frame and its value): rows meet in one aggregate, so frames that
    are dealt by document alike need no shuffle, where a join by page would move every row. Null keys meet nothing."""
    rows = [df.dropna(subset=page).select(*page, value.alias(name)) for name, (df, value) in frames.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), rows).groupBy(*page).agg(*(F.collect_list(name).alias(name) for name in frames))


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each list of a column of numbers starts and ends, and all of its numbers; nulls are not numbers."""
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    return ends, column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)


#: Fixed value: pairs of a page that are compared at a time.
PAIRS = 1 << 20


def pairs_at(f, left: int, rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """f(rows as a column, columns as a row), a bounded number of pairs at a time."""
    step = max(1, PAIRS // max(1, len(columns[0])))
    return np.concatenate([f([x[i : i + step, None] for x in rows], columns) for i in range(0, left, step)]) if left and len(columns[0]) else np.full(left, -1)


def best_block(words: list[np.ndarray], blocks: list[np.ndarray], threshold: float) -> np.ndarray:
    """Index of the best block of each word, or -1, as assign_words() tells; blocks are in order of preference."""
    x0, y0, x1, y1 = words
    bx0, by0, bx1, by1 = blocks
    xc, yc, own = (x0 + x1) / 2, (y0 + y1) / 2, (x1 - x0) * (y1 - y0)
    near = (by0 <= y1) & (by1 >= y0) & (bx0 <= x1) & (bx1 >= x0)
    inside = (xc >= bx0) & (xc <= bx1) & (yc >= by0) & (yc <= by1)
    wide = np.maximum(np.minimum(x1, bx1) - np.maximum(x0, bx0), 0.0) * np.maximum(np.minimum(y1, by1) - np.maximum(y0, by0), 0.0)
    share = np.divide(wide, own, out=np.zeros_like(wide), where=np.broadcast_to(own > 0, wide.shape))
    score = np.where(near, np.where(inside, -np.inf, -share), np.inf)
    best = score.argmin(axis=1)
    return np.where(score[np.arange(len(best)), best] <= -threshold, best, -1)


def indices(found: list[np.ndarray]) -> pa.Array:
    """Lists of indices, null for -1."""
    flat = np.concatenate([np.empty(0, np.int32), *found]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(flat, mask=flat < 0))


def assign_words(df: DataFrame, blocks: DataFrame, page: list[str], threshold: float = 0.5, sizes: DataFrame | None = None) -> DataFrame:
    """source_index of the best block of each word, or null: a block around its centre (smallest first), else the one that
    covers most of it, if at least `threshold`; then the smaller area, then the smaller box.

    sizes (page keys, pdf_width, pdf_height, ocr_width, ocr_height, unscorable) brings words and blocks to shares of the
    page; on a page that cannot be scored no word is assigned. A page's words and blocks meet in one row and are compared there.
    """
    ones = ("x0", "y0", "x1", "y1")
    kept = [c for c in df.columns if c not in page]
    frames = {"_w": (df, F.struct(*kept)), "_b": (blocks, F.struct(*ones, "source_index"))}
    if sizes is not None:
        frames["_s"] = (sizes.where(~F.col("unscorable")), F.struct("pdf_width", "pdf_height", "ocr_width", "ocr_height"))
    pages = meeting(page, **frames)
    size = lambda kind, c: F.lit(1.0) if sizes is None else F.get("_s", F.lit(0))[f"{kind}_{'width' if c[0] == 'x' else 'height'}"].cast("double")
    shares = F.transform("_b", lambda b: F.struct(*((b[c] / size("ocr", c)).alias(c) for c in ones), b["source_index"].alias("i")))
    ranked = F.sort_array(F.transform(shares, lambda b: F.struct(((b["x1"] - b["x0"]) * (b["y1"] - b["y0"])).alias("area"), *(b[c].alias(c) for c in ones), b["i"].alias("i"))))
    pages = pages.select(*page, "_w", ranked.alias("_b"), *(size("pdf", c).alias(f"_{c}") for c in ("x", "y")))

    @F.arrow_udf("array<int>")
    def best(*columns: pa.Array) -> pa.Array:
        lists = [ragged(c) for c in columns[:8]]
        across, down = (c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in columns[8:])
        out = []
        for k in range(len(columns[0])):
            w, b = ([x[ends[k] : ends[k + 1]] for ends, x in lists[i : i + 4]] for i in (0, 4))
            w = [x / (across[k], down[k])[i % 2] for i, x in enumerate(w)]
            out.append(pairs_at(lambda x, y: best_block(x, y, threshold), len(w[0]), w, b))
        return indices(out)

    args = [F.col(f"{a}.{c}").cast("array<double>") for a in ("_w", "_b") for c in ones]
    pages = pages.select(*page, "_w", F.col("_b.i").alias("_i"), best(*args, F.col("_x"), F.col("_y")).alias("_n"))
    told = F.transform("_n", lambda n: F.get("_i", n)).alias("source_index")
    return pages.select(*page, F.inline(F.arrays_zip(*(F.col(f"_w.{c}").alias(c) for c in kept), told))).select(*df.columns, "source_index")


def block_at(points: DataFrame, blocks: DataFrame, page: list[str], slack: float = 1.0) -> DataFrame:
    """First block, in list order, around each point."""
    packed = blocks.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("source_index", "x0", "y0", "x1", "y1"))).alias("_b"))
    hit = lambda b: (F.col("px") >= b["x0"] - slack) & (F.col("px") <= b["x1"] + slack) & (F.col("py") >= b["y0"] - slack) & (F.col("py") <= b["y1"] + slack)
    found = F.filter("_b", hit)
    return points.join(packed, page, "left").select(*points.columns, F.try_element_at(found, F.lit(1))["source_index"].alias("source_index"))


def merge_extras(fragments: DataFrame, extras: DataFrame, page: list[str]) -> DataFrame:
    """Final order of a page: an extra goes before the first fragment whose y0 is strictly greater, ties after; extras without
    y0 go last; fragments keep their order. Columns: page keys, pos or seq, y0, md."""
    packed = fragments.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("pos", "y0"))).alias("_f"))
    after = F.try_element_at(F.filter("_f", lambda f: f["y0"] > F.col("y0")), F.lit(1))["pos"]
    placed = extras.join(packed, page, "left").select(*page, F.coalesce(F.when(F.col("y0").isNotNull(), after), F.lit(2147483647)).alias("slot"), F.lit(0).alias("is_fragment"), F.when(F.col("y0").isNull(), 1).otherwise(0).alias("tail"), F.col("y0"), F.col("seq"), "md")
    base = fragments.select(*page, F.col("pos").alias("slot"), F.lit(1).alias("is_fragment"), F.lit(0).alias("tail"), "y0", F.lit(0).cast("long").alias("seq"), "md")
    w = Window.partitionBy(*page).orderBy("slot", "is_fragment", "tail", F.asc_nulls_last("y0"), "seq")
    return base.unionByName(placed).withColumn("rank", F.row_number().over(w)).select(*page, "rank", "md")


def insertion_anchor(targets: DataFrame, ordered: DataFrame, page: list[str]) -> DataFrame:
    """Predecessor (largest centre not past the target) and successor (smallest centre past it); none if their order is not monotone."""
    packed = ordered.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("centre", "pos"))).alias("_o"))
    rows = targets.join(packed, page, "left")
    before = F.array_max(F.filter("_o", lambda o: o["centre"] <= F.col("centre")))
    after = F.array_min(F.filter("_o", lambda o: o["centre"] > F.col("centre")))
    rows = rows.withColumn("_p", before).withColumn("_s", after)
    bad = F.col("_p.pos") >= F.col("_s.pos")
    return rows.select(*page, "id", F.when(~F.coalesce(bad, F.lit(False)), F.col("_p.pos")).alias("after_pos"), F.when(~F.coalesce(bad, F.lit(False)), F.col("_s.pos")).alias("before_pos"))


def side_by_side(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Whether two text blocks of a page overlap in height by over half the shorter one and not at all in width."""
    packed = blocks.groupBy(*page).agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("_b"))

    def beside(a, b):
        tall = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
        return (tall > 0.5 * F.least(a["y1"] - a["y0"], b["y1"] - b["y0"])) & ((a["x1"] <= b["x0"]) | (b["x1"] <= a["x0"]))

    return packed.select(*page, F.exists("_b", lambda a: F.exists("_b", lambda b: beside(a, b))).alias("columns"))


def _laid_out(spark, sf_dir):
    return words(table(spark, sf_dir, "documents"))


def _blocks(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id", "page", F.expr("line_no div 5").cast("int").alias("source_index")).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def _banded(spark, sf_dir):
    """Words whose first line of a page is a running header or a number row on some documents."""
    first = (F.col("ix") % 600) < 12
    place = F.col("ix") % 12
    head = F.element_at(F.array(*map(F.lit, ["US", "10,155,111", "B2"])), F.least(place + 1, F.lit(3)).cast("int"))
    word = F.when(first & (F.col("doc_id") % 3 == 1) & (place < 3), head).when(first & (F.col("doc_id") % 3 == 2) & (place < 2), (place + 11).cast("string")).otherwise(F.col("word"))
    rows = _laid_out(spark, sf_dir).withColumn("word", word)
    return rows.where(~(first & (F.col("doc_id") % 3 == 2) & (place >= 2)))


def band_strip(spark, sf_dir):
    pages = _banded(spark, sf_dir).groupBy("doc_id", "page").agg(packed_words().alias("words"), median_height().alias("_h"))
    removed = F.size("removed").cast("long")
    return strip_bands(pages, 792.0).select("doc_id", "page", removed.alias("removed"), (F.size("words") - removed).alias("kept"))


def _ladder(spark, sf_dir):
    """Words with a ladder of line numbers, a sheet header and a page header on some pages."""
    at = F.col("ix") % 600
    sheet = F.element_at(F.array(*map(F.lit, ["Sheet", "3", "of", "9"])), F.greatest(F.least(at - 19, F.lit(4)), F.lit(1)).cast("int"))
    word = F.when(F.expr("ix % 12 = 6 AND (ix div 12) % 5 = 4 AND doc_id % 4 <> 1"), F.expr("cast((ix % 600) div 12 + 1 as string)")) \
        .when((F.col("doc_id") % 6 == 1) & at.between(20, 23), sheet).when((F.col("doc_id") % 5 == 3) & (at == 3), "Page").when((F.col("doc_id") % 5 == 3) & (at == 4), "12").otherwise(F.col("word"))
    return _laid_out(spark, sf_dir).withColumn("word", word)


def page_kind(spark, sf_dir):
    out = page_kinds(_ladder(spark, sf_dir), ["doc_id"], "page", 612.0)
    return out.select("doc_id", "page", "n", "ladder", "gutter", "kind", F.array_join(F.transform("ladder_x", lambda x: x.cast("string")), ",").alias("ladder_x"))


def page_medians(spark, sf_dir):
    return medians(_laid_out(spark, sf_dir), ["doc_id", "page"])


def height_index(spark, sf_dir):
    rows = _laid_out(spark, sf_dir)
    return height_split(rows, ["doc_id", "page"], F.when(F.col("ix") % 3 == 0, 16.0).otherwise(8.0 + F.col("ix") % 5))


def line_groups(spark, sf_dir):
    rows = _laid_out(spark, sf_dir).withColumn("y0", F.col("y0") + F.col("ix") % 3)
    return group_lines(rows.withColumn("y1", F.col("y0") + 8), ["doc_id", "page"], F.lit(4.0))


def line_texts(spark, sf_dir):
    """Lines of words among which marks of all kinds stand at narrow and wide gaps."""
    marks = F.element_at(F.array(*map(F.lit, ["(", ".", "-", ",", "f(", ".5", "*", "[", "”", ";", "/", "§"])), (F.col("ix") % 13 % 12 + 1).cast("int"))
    rows = _laid_out(spark, sf_dir).withColumn("word", F.when((F.col("ix") + F.col("doc_id")) % 4 == 0, marks).otherwise(F.col("word")))
    rows = rows.withColumn("x0", F.col("x0") - F.col("ix") % 3 * 4)
    return join_lines(rows, ["doc_id", "page", "line_no"], F.lit(5.5)).drop("x0", "y0")


def paragraph_breaks(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("p"), F.max("l_suppkey").alias("s"), F.max("l_returnflag").alias("f"))
    ends = F.element_at(F.array(*map(F.lit, ["a- b", "con-", "x.", "7-", "-", "é-"])), (F.col("p") % 6 + 1).cast("int"))
    lines = lines.select("l_orderkey", F.col("l_linenumber").alias("line_no"), (72.0 + F.col("p") % 3 * 4).alias("x0"), (F.col("l_linenumber") * 10.0 + F.col("s") % 2 * 8 * (F.col("l_linenumber") % 2)).alias("y"), F.concat(F.when(F.col("s") % 3 == 0, F.col("f")).otherwise(F.lower("f")), F.lit(" "), ends).alias("text"))
    return paragraphs(lines, ["l_orderkey"], F.lit(6.0), F.lit(10.0))


def merged_paragraphs(spark, sf_dir):
    ends = F.element_at(F.array(*map(F.lit, ["", ".”", ";", "?) ", " ')", ":"])), (F.col("turn") % 6 + 1).cast("int"))
    body = F.regexp_replace("text", r"[^\p{L}\p{N} ]", "")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 8 == 7, ends).otherwise(F.concat(F.when(F.col("turn") % 3 == 1, body).otherwise(F.lower(body)), ends)).alias("text"), F.when((F.col("conv_id") + F.col("turn")) % 4 != 0, "first").otherwise("indent").alias("new_by"))
    return merge_continuations(turns, ["conv_id"], ["turn"])


def word_block_assign(spark, sf_dir):
    """Words assigned to blocks in pixels of twice their size; some pages cannot be scored."""
    rows = _laid_out(spark, sf_dir)
    shift = F.col("ix") % 2 * 9
    shifted = rows.withColumn("y0", F.col("y0") + shift).withColumn("y1", F.col("y1") + shift)
    blocks = _blocks(rows).where("(page + source_index) % 4 <> 3")
    blocks = blocks.select("doc_id", "page", "source_index", *((F.col(c) * 2).alias(c) for c in ("x0", "y0", "x1", "y1")))
    sizes = blocks.select("doc_id", "page").distinct().select("doc_id", "page", F.lit(612.0).alias("pdf_width"), F.lit(792.0).alias("pdf_height"), F.lit(1224.0).alias("ocr_width"), F.lit(1584.0).alias("ocr_height"), ((F.col("doc_id") + F.col("page")) % 13 == 0).alias("unscorable"))
    return assign_words(shifted.select("doc_id", "page", "ix", "x0", "y0", "x1", "y1"), blocks, ["doc_id", "page"], sizes=sizes).select("doc_id", "ix", "source_index")


def points_in_blocks(spark, sf_dir):
    rows = _laid_out(spark, sf_dir)
    points = rows.where("ix % 5 = 0").select("doc_id", "page", "ix", F.col("x1").alias("px"), (F.col("y1") + F.col("ix") % 3).alias("py"))
    return block_at(points, _blocks(rows), ["doc_id", "page"]).select("doc_id", "ix", "source_index")


def extras_merged(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("y0", (F.col("turn") * 37 % 101).cast("double"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    frags = turns.where("turn % 2 = 0").select("conv_id", F.row_number().over(w).alias("pos"), "y0", F.col("turn").cast("string").alias("md"))
    extras = turns.where("turn % 2 = 1").select("conv_id", F.col("turn").cast("long").alias("seq"), F.when(F.col("turn") % 5 != 0, F.col("y0")).alias("y0"), F.col("turn").cast("string").alias("md"))
    return merge_extras(frags, extras, ["conv_id"])


def insertion_anchors(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("id"), (F.col("turn") * 37 % 101).alias("centre"), F.col("turn").alias("pos"))
    return insertion_anchor(turns.where("id % 3 = 0").select("conv_id", "id", "centre"), turns.where("id % 3 <> 0"), ["conv_id"])


def column_layout(spark, sf_dir):
    boxes = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 2 * 300.0).alias("x0"), (F.col("l_linenumber") * 30.0).alias("y0"), (F.col("l_partkey") % 2 * 300.0 + 200).alias("x1"), (F.col("l_linenumber") * 30.0 + 20 + F.col("l_suppkey") % 50).alias("y1"))
    return side_by_side(boxes, ["l_orderkey"])


QUERIES = {f.__name__: f for f in (band_strip, page_kind, page_medians, height_index, line_groups, line_texts, paragraph_breaks, merged_paragraphs, word_block_assign, points_in_blocks, extras_merged, insertion_anchors, column_layout)}

_W = "WITH " + WORDS
ORACLE = {
    "band_strip": _W + r""", v AS (SELECT * REPLACE (CASE WHEN ix % 600 < 12 AND doc_id % 3 = 1 AND ix % 12 < 3 THEN (['US', '10,155,111', 'B2'])[ix % 12 + 1] WHEN ix % 600 < 12 AND doc_id % 3 = 2 AND ix % 12 < 2 THEN CAST(ix % 12 + 11 AS VARCHAR) ELSE word END AS word)
  FROM words WHERE NOT (ix % 600 < 12 AND doc_id % 3 = 2 AND ix % 12 >= 2)),
 z AS (SELECT *, CASE WHEN (y0 + y1) / 2 < 0.11 * 792 THEN 'head' WHEN (y0 + y1) / 2 > 0.92 * 792 THEN 'foot' END AS zone FROM v),
 l AS (SELECT doc_id, page, zone, line_no, string_agg(word, ' ' ORDER BY x0, ix) AS t FROM z WHERE zone IS NOT NULL GROUP BY ALL),
 b AS (SELECT * FROM l WHERE regexp_matches(t, '(?i)(U\.?\s*S\.?\s*Patent|US\s*[0-9,]+\s*B[12]|Sheet\s+[0-9]+\s+of\s+[0-9]+|^US0?[0-9]{6,}|\bPage\s+[0-9]+)') OR regexp_full_match(t, '[0-9]{1,4}\.?(\s+[0-9]{1,4}\.?)?'))
 SELECT z.doc_id, z.page, count(*) FILTER (b.t IS NOT NULL) AS removed, count(*) FILTER (b.t IS NULL) AS kept FROM z LEFT JOIN b USING (doc_id, page, zone, line_no) GROUP BY ALL""",
    "page_kind": _W + r""", v AS (SELECT * REPLACE (CASE WHEN ix % 12 = 6 AND (ix // 12) % 5 = 4 AND doc_id % 4 <> 1 THEN CAST((ix % 600) // 12 + 1 AS VARCHAR) WHEN doc_id % 6 = 1 AND ix % 600 BETWEEN 20 AND 23 THEN (['Sheet', '3', 'of', '9'])[ix % 600 - 19]
   WHEN doc_id % 5 = 3 AND ix % 600 = 3 THEN 'Page' WHEN doc_id % 5 = 3 AND ix % 600 = 4 THEN '12' ELSE word END AS word), (x0 + x1) / 2 AS xc FROM words),
 m AS (SELECT *, regexp_full_match(word, '[0-9]{1,9}') AND TRY_CAST(word AS INTEGER) % 5 = 0 AND TRY_CAST(word AS INTEGER) BETWEEN 5 AND 70 AND abs(xc - 306) <= 35 AS rung, row_number() OVER (PARTITION BY doc_id, page ORDER BY ix) AS place FROM v),
 g AS (SELECT doc_id, page, coalesce(median(CAST(xc AS DOUBLE)) FILTER (rung), 306.0) AS gutter FROM m GROUP BY ALL),
 s AS (SELECT doc_id, page, gutter, count(*) AS n, count(*) FILTER (rung) AS ladder, count(*) FILTER (xc < gutter - 20) AS l, count(*) FILTER (xc > gutter + 20) AS r, string_agg(word, ' ' ORDER BY ix) FILTER (place <= 15) AS head, string_agg(word, ' ' ORDER BY ix) AS t,
   coalesce(string_agg(CAST(CAST(xc AS DOUBLE) AS VARCHAR), ',' ORDER BY xc) FILTER (rung), '') AS ladder_x FROM m JOIN g USING (doc_id, page) GROUP BY ALL)
 SELECT doc_id, page, n, ladder, gutter, ladder_x, CASE WHEN page = 0 THEN 'COVER' WHEN regexp_matches(head, '\bPage\s+[0-9]') THEN 'FRONT_MATTER' WHEN ladder >= 6 OR (ladder >= 2 AND l >= 80 AND r >= 80) THEN 'SPEC_BODY'
  WHEN regexp_matches(t, 'Sheet\s+[0-9]+\s+[Oo]f\s+[0-9]+') OR n < 150 THEN 'FIGURE' ELSE 'FRONT_MATTER' END AS kind FROM s""",
    "page_medians": _W + r""" SELECT doc_id, page, coalesce(median(CASE WHEN regexp_full_match(word, '\p{L}{3,}') THEN CAST(x1 - x0 AS DOUBLE) / length(word) END), 6.0) AS char_width, coalesce(median(CAST(y1 - y0 AS DOUBLE)), 10.0) AS height FROM words GROUP BY ALL""",
    "height_index": _W + """, h AS (SELECT doc_id, page, list_sort(list(CAST(CASE WHEN ix % 3 = 0 THEN 16.0 ELSE 8.0 + ix % 5 END AS DOUBLE))) AS h FROM words GROUP BY ALL)
 SELECT doc_id, page, h[len(h) // 10 + 1] AS p10, h[len(h) // 2 + 1] AS p50, h[len(h) // 2 + 1] / h[len(h) // 10 + 1] >= 1.3 AS bimodal, CAST(len(list_filter(h, lambda x: x >= h[len(h) // 10 + 1] * 1.6)) AS INTEGER) AS tall FROM h""",
    "line_groups": "WITH RECURSIVE " + WORDS + """, w AS (SELECT doc_id, page, ix, y0 + ix % 3 + 4 AS yc, row_number() OVER (PARTITION BY doc_id, page ORDER BY y0 + ix % 3, ix) AS place FROM words),
 f AS (SELECT doc_id, page, ix, place, yc, 0 AS line, [yc] AS ys FROM w WHERE place = 1
  UNION ALL SELECT w.doc_id, w.page, w.ix, w.place, w.yc, CASE WHEN abs(w.yc - list_median(f.ys)) <= 4 THEN f.line ELSE f.line + 1 END, CASE WHEN abs(w.yc - list_median(f.ys)) <= 4 THEN list_append(f.ys, w.yc) ELSE [w.yc] END
   FROM f JOIN w ON w.doc_id = f.doc_id AND w.page = f.page AND w.place = f.place + 1)
 SELECT doc_id, page, CAST(ix AS INTEGER) AS ix, CAST(line AS INTEGER) AS line FROM f""",
    "line_texts": _W + r""", v AS (SELECT * REPLACE (CASE WHEN (ix + doc_id) % 4 = 0 THEN (['(', '.', '-', ',', 'f(', '.5', '*', '[', '”', ';', '/', '§'])[ix % 13 % 12 + 1] ELSE word END AS word, x0 - ix % 3 * 4 AS x0) FROM words),
 p AS (SELECT *, lag(word) OVER w AS b, x0 - lag(x1) OVER w AS gap FROM v WINDOW w AS (PARTITION BY doc_id, page, line_no ORDER BY x0, ix)),
 s AS (SELECT *, CASE WHEN b IS NULL OR word IN (',', '.', ';', ':', '!', '?', ')', ']', '}', '%', '’', '”', '''', '"', '°', '/', '-') OR b IN ('(', '[', '{', '“', '‘', '$', '/', '-') THEN '' WHEN b IN (',', ';') AND regexp_matches(word, '^\p{L}') THEN ' '
   WHEN (regexp_full_match(word, '[^\p{L}\p{N}]') OR regexp_full_match(b, '[^\p{L}\p{N}]')) AND NOT gap > 5.5 THEN '' ELSE ' ' END AS sep FROM p)
 SELECT doc_id, page, line_no, string_agg(sep || word, '' ORDER BY x0, ix) AS text FROM s GROUP BY ALL""",
    "paragraph_breaks": r"""WITH l AS (SELECT l_orderkey, l_linenumber AS line_no, 72.0 + p % 3 * 4 AS x0, l_linenumber * 10.0 + s % 2 * 8 * (l_linenumber % 2) AS y, (CASE WHEN s % 3 = 0 THEN f ELSE lower(f) END) || ' ' || (['a- b', 'con-', 'x.', '7-', '-', 'é-'])[p % 6 + 1] AS text FROM
  (SELECT l_orderkey, l_linenumber, max(l_partkey) AS p, max(l_suppkey) AS s, max(l_returnflag) AS f FROM lineitem GROUP BY ALL)),
 m AS (SELECT l_orderkey, list_sort(list(x0))[count(*) // 10 + 1] AS margin FROM l GROUP BY l_orderkey),
 n AS (SELECT l.*, CASE WHEN x0 > margin + 6 THEN 'indent' WHEN y - lag(y) OVER w > 17 THEN 'gap' WHEN lag(y) OVER w IS NULL THEN 'first' END AS by_ FROM l JOIN m USING (l_orderkey) WINDOW w AS (PARTITION BY l_orderkey ORDER BY line_no)),
 p AS (SELECT *, CAST(count(by_) OVER (PARTITION BY l_orderkey ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS para FROM n),
 q AS (SELECT *, coalesce(by_ IS NULL AND regexp_matches(lag(text) OVER w, '\p{L}-$') AND regexp_matches(text, '^\p{Ll}'), false) AS soft FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY line_no)),
 r AS (SELECT *, coalesce(lead(soft) OVER (PARTITION BY l_orderkey ORDER BY line_no), false) AS cut FROM q)
 SELECT l_orderkey, para, string_agg(CASE WHEN soft OR by_ IS NOT NULL THEN '' ELSE ' ' END || CASE WHEN cut THEN text[:-2] ELSE text END, '' ORDER BY line_no) AS text, count(*) AS lines, max(by_) AS new_by FROM r GROUP BY ALL""",
    "merged_paragraphs": r"""WITH e AS (SELECT *, (['', '.”', ';', '?) ', ' '')', ':'])[turn % 6 + 1] AS ends, regexp_replace(text, '[^\p{L}\p{N} ]', '', 'g') AS body FROM conversations),
 t AS (SELECT conv_id, turn, CASE WHEN turn % 8 = 7 THEN ends ELSE (CASE WHEN turn % 3 = 1 THEN body ELSE lower(body) END) || ends END AS text, (conv_id + turn) % 4 <> 0 AS first FROM e),
 b AS (SELECT *, regexp_replace(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '[’”"'')\]\s]+$', '') AS bare FROM t),
 n AS (SELECT *, CASE WHEN first AND bare <> '' AND bare[-1] NOT IN ('.', '!', '?', ':') AND regexp_matches(text, '^[^\p{L}]*\p{Ll}') THEN 0 ELSE 1 END AS new FROM b),
 p AS (SELECT *, CAST(sum(new) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS merged, coalesce(lead(new) OVER (PARTITION BY conv_id ORDER BY turn), 1) AS last FROM n)
 SELECT conv_id, merged, string_agg(CASE WHEN new = 0 AND last = 0 THEN trim(text, ' ') WHEN new = 0 THEN ltrim(text, ' ') WHEN last = 0 THEN rtrim(text, ' ') ELSE text END, ' ' ORDER BY turn) AS text, count(*) AS pieces FROM p GROUP BY ALL""",
    "word_block_assign": _W + """, o AS (SELECT doc_id, page, CAST(line_no // 5 AS INTEGER) AS source_index, min(x0) * 2 / 1224.0 AS bx0, min(y0) * 2 / 1584.0 AS by0, max(x1) * 2 / 1224.0 AS bx1, max(y1) * 2 / 1584.0 AS by1 FROM words GROUP BY doc_id, page, CAST(line_no // 5 AS INTEGER)),
 b AS (SELECT * FROM o WHERE (page + source_index) % 4 <> 3 AND (doc_id + page) % 13 <> 0),
 s AS (SELECT doc_id, page, ix, CAST(x0 AS DOUBLE) / 612.0 AS x0, CAST(x1 AS DOUBLE) / 612.0 AS x1, CAST(y0 + ix % 2 * 9 AS DOUBLE) / 792.0 AS y0, CAST(y1 + ix % 2 * 9 AS DOUBLE) / 792.0 AS y1 FROM words),
 j AS (SELECT s.doc_id, ix, source_index, (x0 + x1) / 2 BETWEEN bx0 AND bx1 AND (y0 + y1) / 2 BETWEEN by0 AND by1 AS inside,
  greatest(least(x1, bx1) - greatest(x0, bx0), 0) * greatest(least(y1, by1) - greatest(y0, by0), 0) / ((x1 - x0) * (y1 - y0)) AS share, (bx1 - bx0) * (by1 - by0) AS area, bx0, by0, bx1, by1 FROM s LEFT JOIN b USING (doc_id, page)),
 r AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY doc_id, ix ORDER BY NOT inside, CASE WHEN inside THEN 0 ELSE -share END, area, bx0, by0, bx1, by1) = 1)
 SELECT doc_id, CAST(ix AS INTEGER) AS ix, CASE WHEN inside OR share >= 0.5 THEN source_index END AS source_index FROM r""",
    "points_in_blocks": _W + """, b AS (SELECT doc_id, page, CAST(line_no // 5 AS INTEGER) AS source_index, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM words GROUP BY doc_id, page, CAST(line_no // 5 AS INTEGER)),
 p AS (SELECT doc_id, page, ix, x1 AS px, y1 + ix % 3 AS py FROM words WHERE ix % 5 = 0)
 SELECT p.doc_id, CAST(ix AS INTEGER) AS ix, min(source_index) AS source_index FROM p LEFT JOIN b ON b.doc_id = p.doc_id AND b.page = p.page AND px BETWEEN x0 - 1 AND x1 + 1 AND py BETWEEN y0 - 1 AND y1 + 1 GROUP BY ALL""",
    "extras_merged": """WITH t AS (SELECT conv_id, turn, CAST(turn * 37 % 101 AS DOUBLE) AS y0 FROM conversations), f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM t WHERE turn % 2 = 0),
 e AS (SELECT conv_id, turn, CASE WHEN turn % 5 <> 0 THEN y0 END AS y0 FROM t WHERE turn % 2 = 1),
 p AS (SELECT e.*, coalesce((SELECT min(pos) FROM f WHERE f.conv_id = e.conv_id AND f.y0 > e.y0), 2147483647) AS slot FROM e),
 u AS (SELECT conv_id, turn, pos AS slot, 1 AS k, 0 AS tail, y0, 0 AS seq FROM f UNION ALL SELECT conv_id, turn, slot, 0, CASE WHEN y0 IS NULL THEN 1 ELSE 0 END, y0, turn FROM p)
 SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY slot, k, tail, y0 NULLS LAST, seq) AS INTEGER) AS rank, CAST(turn AS VARCHAR) AS md FROM u""",
    "insertion_anchors": """WITH t AS (SELECT conv_id, turn, turn * 37 % 101 AS c FROM conversations),
 a AS (SELECT e.conv_id, e.turn AS id, arg_max(o.turn, (o.c, o.turn)) FILTER (o.c <= e.c) AS p, arg_min(o.turn, (o.c, o.turn)) FILTER (o.c > e.c) AS s FROM t e LEFT JOIN t o ON o.conv_id = e.conv_id AND o.turn % 3 <> 0 WHERE e.turn % 3 = 0 GROUP BY ALL)
 SELECT conv_id, id, CASE WHEN coalesce(p >= s, false) THEN NULL ELSE p END AS after_pos, CASE WHEN coalesce(p >= s, false) THEN NULL ELSE s END AS before_pos FROM a""",
    "column_layout": """WITH b AS (SELECT l_orderkey, l_partkey % 2 * 300.0 AS x0, l_linenumber * 30.0 AS y0, l_partkey % 2 * 300.0 + 200 AS x1, l_linenumber * 30.0 + 20 + l_suppkey % 50 AS y1 FROM lineitem)
 SELECT a.l_orderkey, bool_or(least(a.y1, b.y1) - greatest(a.y0, b.y0) > 0.5 * least(a.y1 - a.y0, b.y1 - b.y0) AND (a.x1 <= b.x0 OR b.x1 <= a.x0)) AS columns FROM b a JOIN b ON a.l_orderkey = b.l_orderkey GROUP BY a.l_orderkey""",
}
