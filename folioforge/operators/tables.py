"""HTML tables: grid, structure lint, header fingerprint, pipe tables, and reconciliation of their numbers.

A table is parsed once, by an Arrow UDF; everything else about it reads that struct or the rows it holds.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from folioforge.functions import folds
from folioforge.sources.tables import table

#: A span past this is reported as invalid and counts as 1, so that no table fills memory.
MOST_SPAN = 1000
#: Tags of a table's structure and of pictures.
STRUCTURE = frozenset("table thead tbody tfoot tr td th caption colgroup col".split())
PICTURES = frozenset(("img", "svg", "canvas", "chart"))


_TOKEN = re.compile(r"<(/?)(" + "|".join(sorted(STRUCTURE, key=len, reverse=True)) + r")((?: (?:row|col)span=[0-9]+)*)>|([^<&$]+)")
_PLAIN = re.compile(r"(?:<(?:/(?:" + "|".join(STRUCTURE) + r")|(?:" + "|".join(STRUCTURE) + r")(?: (?:row|col)span=[0-9]+)*)>|[^<&$\r\0]++)*+")
_ATTRIBUTE = re.compile(r"((?:row|col)span)=([0-9]+)")


@dataclass
class Table:
    """Cells (row, col, rowspan, colspan, header, text) of the first table, and what else its markup held."""

    cells: list[tuple] = field(default_factory=list)
    rows: int = 0
    cols: int = 0
    header_rows: int = 0
    roots: int = 0
    tables: int = 0
    orphans: int = 0
    pictures: int = 0
    others: int = 0
    caption: str | None = None


class _Reader(HTMLParser):
    """Rows of the first top-level table, each a list of [tag, rowspan, colspan, text]; a table inside a cell is text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.rows, self.heads = Table(), [], []
        self.depth, self.section, self.row, self.cell, self.caption = 0, None, None, None, None

    @property
    def inside(self) -> bool:
        return self.depth == 1 and self.out.roots == 1

    def plain(self, html: str) -> bool:
        """Reads markup of structural tags and text without entities or dollars directly, which takes a fraction of the general
        reader's time; tells whether it could."""
        if not _PLAIN.fullmatch(html):
            return False
        for slash, tag, attrs, text in _TOKEN.findall(html):
            if text:
                self.handle_data(text)
            elif slash:
                self.handle_endtag(tag)
            else:
                self.handle_starttag(tag, _ATTRIBUTE.findall(attrs) if attrs else ())
        return True

    def end_row(self) -> None:
        if self.row is not None:
            self.rows.append(self.row)
            self.heads.append(self.section == "thead")
        self.row = self.cell = None

    def handle_starttag(self, tag, attrs):
        self.out.others += tag not in STRUCTURE
        if tag == "table":
            self.depth += 1
            self.out.tables += 1
            self.out.roots += self.depth == 1
        elif not self.inside:
            return
        elif tag in PICTURES:
            self.out.pictures += 1
        elif tag in ("thead", "tbody", "tfoot"):
            self.section = tag
        elif tag == "caption":
            self.caption = []
        elif tag == "tr":
            self.end_row()
            self.row = []
        elif tag in ("td", "th"):
            if self.row is None:
                self.out.orphans += 1
                self.cell = None
                return
            given = dict(attrs)
            self.cell = [tag, _span(given, "rowspan"), _span(given, "colspan"), ""]
            self.row.append(self.cell)

    def handle_endtag(self, tag):
        if tag == "table":
            if self.depth == 1:
                self.end_row()
            self.depth = max(0, self.depth - 1)
        elif not self.inside:
            return
        elif tag in ("thead", "tbody", "tfoot"):
            self.section = None
        elif tag == "caption":
            if self.out.caption is None and self.caption is not None:
                self.out.caption = " ".join("".join(self.caption).split())
            self.caption = None
        elif tag == "tr":
            self.end_row()
        elif tag in ("td", "th"):
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell[3] += data
        elif self.caption is not None:
            self.caption.append(data)


def _span(given: dict, name: str) -> int:
    """1 if absent, 0 for what is no number or past MOST_SPAN."""
    if name not in given:
        return 1
    text = (given[name] or "").strip()
    return int(text) if re.fullmatch(r"[+-]?[0-9]{1,9}", text) and int(text) <= MOST_SPAN else 0


def parse(html: str | None) -> Table:
    """The first table by the next-free-column rule. A less-than sign inside inline math is text. Never raises for its input."""
    reader = _Reader()
    if not reader.plain(html or ""):
        reader.feed(re.sub(r"(\$\$?)([^$]*)\1", lambda m: m[1] + m[2].replace("<", "&lt;") + m[1], html or ""))
        reader.close()
    reader.end_row()
    out = reader.out
    out.rows = len(reader.rows)
    taken: set[tuple[int, int]] = set()
    for r, row in enumerate(reader.rows):
        c = 0
        for tag, down, across, text in row:
            while (r, c) in taken:
                c += 1
            out.cells.append((r, c, down, across, tag == "th", " ".join(text.split())))
            taken.update((i, c + j) for i in range(r, min(r + max(down, 1), out.rows)) for j in range(max(across, 1)))
            c += max(across, 1)
            out.cols = max(out.cols, c)
    if any(reader.heads):
        out.header_rows = sum(reader.heads)
    elif reader.rows and reader.rows[0] and all(x[0] == "th" for x in reader.rows[0]):
        out.header_rows = 1
    return out


def problems(t: Table) -> list[tuple[str, int | None, int | None]]:
    """(code, row, col) of each structural problem; an empty table ends the list."""
    found: list[tuple[str, int | None, int | None]] = []
    if t.roots > 1:
        found.append(("multiple_table_roots", None, None))
    if t.orphans:
        found.append(("orphan_cell", None, None))
    if not t.cells:
        return [*found, ("empty_table", None, None)]
    taken: set[tuple[int, int]] = set()
    for r, c, down, across, _, _ in t.cells:
        if down < 1 or across < 1 or r + down > t.rows or c + across > t.cols:
            found.append(("invalid_span", r, c))
        own = {(i, j) for i in range(r, min(r + max(down, 1), t.rows)) for j in range(c, min(c + max(across, 1), t.cols))}
        found += [("overlapping_cells", i, j) for i, j in sorted(own & taken)]
        taken |= own
    found += [("grid_hole", i, j) for i in range(t.rows) for j in range(t.cols) if (i, j) not in taken]
    texts: dict[int, list[str]] = {}
    for r, _, _, _, _, text in t.cells:
        texts.setdefault(r, []).append(text)
    head = [x for r in range(t.header_rows) for x in texts.get(r, [])]
    if head and not any(head):
        found.append(("empty_header", None, None))
    return found + [("empty_row", r, None) for r in range(t.header_rows, t.rows) if texts.get(r) and not any(texts[r])]


#: Problems that make a table unfit for pipes; the others are warnings.
ERRORS = frozenset(("invalid_span", "overlapping_cells"))


def pipes(t: Table) -> str | None:
    """A simple table as Markdown: one root and no table inside, only structural tags, no spans, no error of structure, no bar
    inside math. Other tables give null."""
    texts = [x[5] for x in t.cells]
    if t.roots != 1 or t.tables != 1 or t.others or not t.cells or any(x[2] != 1 or x[3] != 1 for x in t.cells):
        return None
    if any(code in ERRORS for code, _, _ in problems(t)) or any("|" in x[a:b] for x in texts for a, b, _ in folds.math_regions(x)):
        return None
    at = {(r, c): _cell(text) for r, c, _, _, _, text in t.cells}
    lines = ["| " + " | ".join(at.get((r, c), "") for c in range(t.cols)) + " |" for r in range(t.rows)]
    lines.insert(1, "| " + " | ".join(["---"] * t.cols) + " |")
    return "\n".join(([f"*{_cell(t.caption)}*", ""] if t.caption else []) + lines)


def _cell(text: str) -> str:
    """A cell's text with tight inline math and escaped bars."""
    return folds.tighten(text).replace("|", "\\|")


def header_fingerprint(t: Table) -> str:
    """SHA-256 of the header cells' normalised texts in order of place; without header rows the first row counts."""
    rows = t.header_rows or min(1, t.rows)
    return hashlib.sha256(" ".join(folds.normalize_prose(x[5], True) for x in sorted(t.cells, key=lambda x: x[:2]) if x[0] < rows).encode()).hexdigest()


_PARSED = (
    "struct<rows: int, cols: int, header_rows: int, roots: int, orphans: int, pictures: int, caption: string, markdown: string, fingerprint: string, "
    "cells: array<struct<row: int, col: int, rowspan: int, colspan: int, header: boolean, text: string>>, problems: array<struct<code: string, row: int, col: int>>>"
)
_CELL, _PROBLEM = ("row", "col", "rowspan", "colspan", "header", "text"), ("code", "row", "col")


#: What each field of a parsed table is made of.
_FIELDS = {
    **{c: (lambda t, c=c: getattr(t, c)) for c in ("rows", "cols", "header_rows", "roots", "orphans", "pictures", "caption")}, "markdown": lambda t: pipes(t), "fingerprint": lambda t: header_fingerprint(t),
    "cells": lambda t: [dict(zip(_CELL, x, strict=True)) for x in t.cells], "problems": lambda t: [dict(zip(_PROBLEM, x, strict=True)) for x in problems(t)],
}


def parsed(html: Column, *fields: str) -> Column:
    """A table's grid, problems, Markdown and header fingerprint, or only the fields named, in one parse; null stays null."""
    chosen = {c: _FIELDS[c] for c in fields or _FIELDS}
    kind = StructType([x for x in DataType.fromDDL(_PARSED) if x.name in chosen])
    described = lambda text: (lambda t: {c: f(t) for c, f in chosen.items()})(parse(text))
    return folds.text_udf(described, kind.simpleString())(html)


#: Forms of numbers for the three explained differences.
_EXPONENT = r"(?:\^|[eE])([-+]?[0-9]+)"
_DECIMAL = r"^[0-9]+(?:[.,][0-9]+)*$"


def _difference(s: Column, o: Column) -> Column:
    """How two numbers that differ may be one: sign_flip, decimal_shift, exponent_change, or null."""
    shift = s["plain"] & o["plain"] & (s["rest"] != o["rest"])
    return F.when((s["rest"] == o["rest"]) & (s["sign"] != o["sign"]), "sign_flip").when(shift, "decimal_shift").when((s["digits"] != "") & ~s["exponent"].eqNullSafe(o["exponent"]), "exponent_change")


def reconcile_numbers(source: DataFrame, output: DataFrame, key: str) -> DataFrame:
    """Bag difference of number and unit tokens (key, token): key, source, output, kind, n for what the source has left over.

    A number that is left pairs with one left in the output where each is the other's only explained partner (and neither is
    left twice): equal but for the sign, the same digits with the point elsewhere, or the same mantissa with another
    exponent. Others are numeric_missing; units are unit_missing. Signed counts make the bag difference one shuffle; what
    is left meets by its digits, so there is no cross product.
    """
    both = source.select(key, "token", F.lit(1).alias("s")).unionByName(output.select(key, "token", F.lit(-1).alias("s")))
    left = both.groupBy(key, "token").agg(F.sum("s").alias("_left")).where("_left <> 0")
    rest = F.regexp_replace("token", "^[-+]", "")
    exponent = F.nullif(F.regexp_extract("token", _EXPONENT, 1), F.lit(""))
    digits = F.regexp_replace(F.regexp_replace(F.when(exponent.isNull(), rest).otherwise(F.regexp_extract("token", "^(.*?)" + _EXPONENT, 1)), "[^0-9]", ""), "^0+", "")
    form = F.struct(F.col("token").alias("token"), F.abs("_left").alias("n"), F.regexp_extract("token", "^[-+]?", 0).alias("sign"), rest.alias("rest"), digits.alias("digits"), exponent.alias("exponent"), rest.rlike(_DECIMAL).alias("plain"))
    left = left.withColumn("x", form).withColumn("value", F.col("token").rlike("^[-+0-9]"))
    groups = left.where("value").groupBy(key, F.col("x.digits").alias("_d")).agg(F.collect_list(F.when(F.col("_left") > 0, F.col("x"))).alias("_s"), F.collect_list(F.when(F.col("_left") < 0, F.col("x"))).alias("_o"))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda n, x: n + x["n"])
    rows = groups.select(key, F.explode("_s").alias("x"), "_s", "_o").withColumn("_c", F.filter("_o", lambda o: _difference(F.col("x"), o).isNotNull()))
    rows = rows.withColumn("o", F.when(total("_c") == 1, F.get("_c", F.lit(0))))
    alone = (F.col("x.n") == 1) & (total(F.filter("_s", lambda s: _difference(s, F.col("o")).isNotNull())) == 1)
    kind = F.when(F.col("o").isNotNull() & alone, _difference(F.col("x"), F.col("o")))
    values = rows.withColumn("_k", kind).select(key, F.col("x.token").alias("source"), F.when(F.col("_k").isNotNull(), F.col("o.token")).alias("output"), F.coalesce("_k", F.lit("numeric_missing")).alias("kind"), F.col("x.n").alias("n"))
    units = left.where("NOT value AND _left > 0").select(key, F.col("token").alias("source"), F.lit(None).cast("string").alias("output"), F.lit("unit_missing").alias("kind"), F.col("_left").alias("n"))
    return values.unionByName(units)


def table_status(pictures: Column, source_words: Column, bad_source: Column, n_problems: Column, n_content: Column) -> Column:
    """visual_unscorable with pictures, table_unscorable without a sound source, else SUSPECT with any issue, else OK."""
    return F.when(pictures > 0, "visual_unscorable").when((source_words == 0) | bad_source, "table_unscorable").when((n_problems > 0) | (n_content > 0), "SUSPECT").otherwise("OK")


def order_tables(spark, sf_dir) -> DataFrame:
    """A table an order: rows in the order of their markup; blank rows, holes, wide and invalid spans, blank headers, pictures."""
    q, p = F.col("l_quantity").cast("int").cast("string"), F.col("l_partkey")
    row = F.concat(F.lit("<tr><td>"), F.when(p % 13 == 0, "").otherwise(q), F.lit("</td><td>"), F.when((p % 9 == 0) | (p % 13 == 0), "").otherwise(F.col("l_suppkey").cast("string")), F.lit("</td>"),
                   F.when(p % 11 == 0, "<td colspan=2>x</td>").when(p % 17 == 0, "<td rowspan=0>y</td>").otherwise(""), F.lit("</tr>"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("t"))
    head = F.when(F.col("l_orderkey") % 7 == 0, "<tr><th></th><th> </th></tr>").when(F.col("l_orderkey") % 7 == 1, "").otherwise("<tr><th>q</th><th></th></tr>")
    tail = F.when(F.col("l_orderkey") % 19 == 0, "<table></table>").when(F.col("l_orderkey") % 23 == 0, "<img src=a>").otherwise("")
    return rows.select("l_orderkey", F.concat(F.lit("<table>"), head, "t", F.lit("</table>"), tail).alias("html"))


def _tables(spark, sf_dir, *fields: str):
    return order_tables(spark, sf_dir).select("l_orderkey", parsed(F.col("html"), *fields).alias("t"))


def table_grid(spark, sf_dir):
    return _tables(spark, sf_dir, "cells").select("l_orderkey", F.inline("t.cells"))


def table_lint(spark, sf_dir):
    rows = _tables(spark, sf_dir, "problems").select("l_orderkey", F.explode("t.problems").alias("p"))
    return rows.groupBy("l_orderkey", F.col("p.code").alias("problem")).agg(F.count(F.lit(1)).alias("n"))


def table_pipes(spark, sf_dir):
    return _tables(spark, sf_dir, "markdown").where("t.markdown IS NOT NULL").select("l_orderkey", "t.markdown")


def table_headers(spark, sf_dir):
    """How many tables have one header fingerprint, and their first order."""
    return _tables(spark, sf_dir, "fingerprint").groupBy(F.col("t.fingerprint").alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first"))


def _numbers(spark, sf_dir):
    """Numbers of line items with exponents, units and repeats, and an output that flips, shifts, changes or drops some."""
    li = table(spark, sf_dir, "lineitem")
    token = F.when(F.col("l_suppkey") % 5 == 0, F.concat((F.col("l_partkey") % 40).cast("string"), F.lit("e"), (F.col("l_linenumber") % 3).cast("string"))).otherwise(F.format_string("%d.%02d", F.col("l_partkey") % 200, F.col("l_suppkey") % 90 + 10))
    li = li.select("l_orderkey", token.alias("token"), (F.col("l_linenumber") % 4).alias("n"), F.when(F.col("l_partkey") % 8 == 0, "kV").alias("unit"), (F.col("l_suppkey") % 5 == 0).alias("e"))
    n = F.col("n")
    out = F.when(n == 1, F.concat(F.lit("-"), "token")).when((n == 2) & F.col("e"), F.concat("token", F.lit("1"))).when(n == 2, F.regexp_replace("token", r"(\d)\.(\d)", "$1$2.")).otherwise(F.col("token"))
    units = li.where("unit IS NOT NULL")
    source = li.select("l_orderkey", "token").unionByName(units.select("l_orderkey", F.col("unit").alias("token")))
    output = li.where("n <> 3").select("l_orderkey", out.alias("token")).unionByName(units.where("n <> 2").select("l_orderkey", F.col("unit").alias("token")))
    return source, output


def numeric_reconcile(spark, sf_dir):
    return reconcile_numbers(*_numbers(spark, sf_dir), "l_orderkey")


def table_statuses(spark, sf_dir):
    """Status of each order's table from its structure and its numbers; some have no source or a broken one."""
    source, output = _numbers(spark, sf_dir)
    content = reconcile_numbers(source, output, "l_orderkey").groupBy("l_orderkey").agg(F.sum("n").alias("c")).withColumnRenamed("l_orderkey", "k")
    rows = _tables(spark, sf_dir, "pictures", "problems").select("l_orderkey", F.col("t.pictures").alias("pictures"), F.size("t.problems").alias("problems")).join(content, F.col("l_orderkey") == F.col("k"), "left")
    status = table_status(F.col("pictures") + F.when(F.col("l_orderkey") % 23 == 0, 1).otherwise(0), F.when(F.col("l_orderkey") % 29 == 0, 0).otherwise(5), F.col("l_orderkey") % 31 == 0, F.col("problems"), F.coalesce("c", F.lit(0)))
    return rows.select("l_orderkey", status.alias("status"))


QUERIES = {f.__name__: f for f in (table_grid, table_lint, table_pipes, table_headers, numeric_reconcile, table_statuses)}

#: Rows, cells and problems of order_tables, from the line items.
_GRID = r"""WITH l AS (SELECT l_orderkey AS k, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, CAST(l_suppkey AS VARCHAR) AS s, l_partkey AS p FROM lineitem),
 m AS (SELECT k, CASE WHEN p % 13 = 0 THEN '' ELSE q END AS a, CASE WHEN p % 9 = 0 OR p % 13 = 0 THEN '' ELSE s END AS b, CASE WHEN p % 11 = 0 THEN 'x' WHEN p % 17 = 0 THEN 'y' END AS c FROM l),
 o AS (SELECT *, '<tr><td>' || a || '</td><td>' || b || '</td>' || CASE c WHEN 'x' THEN '<td colspan=2>x</td>' WHEN 'y' THEN '<td rowspan=0>y</td>' ELSE '' END || '</tr>' AS h FROM m),
 r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY h) - CASE WHEN k % 7 = 1 THEN 1 ELSE 0 END AS r FROM o),
 f AS (SELECT k, r, a, b, c, false AS head FROM r UNION ALL SELECT DISTINCT k, 0, CASE WHEN k % 7 = 0 THEN '' ELSE 'q' END, '', NULL, true FROM r WHERE k % 7 <> 1),
 g AS (SELECT k, CAST(r AS INTEGER) AS "row", 0 AS col, 1 AS rowspan, 1 AS colspan, head AS header, a AS text FROM f UNION ALL SELECT k, CAST(r AS INTEGER), 1, 1, 1, head, b FROM f
  UNION ALL SELECT k, CAST(r AS INTEGER), 2, CASE c WHEN 'y' THEN 0 ELSE 1 END, CASE c WHEN 'x' THEN 2 ELSE 1 END, head, c FROM f WHERE c IS NOT NULL),
 w AS (SELECT k, max(CASE c WHEN 'x' THEN 4 WHEN 'y' THEN 3 ELSE 2 END) AS cols, count(*) FILTER (c = 'y') AS ys FROM f GROUP BY k),
 pr AS (SELECT k, 'multiple_table_roots' AS problem, 1 AS n FROM w WHERE k % 19 = 0 UNION ALL SELECT k, 'invalid_span', ys FROM w WHERE ys > 0
  UNION ALL SELECT k, 'grid_hole', sum(cols - CASE c WHEN 'x' THEN 4 WHEN 'y' THEN 3 ELSE 2 END) AS n FROM f JOIN w USING (k) GROUP BY k HAVING n > 0
  UNION ALL SELECT k, 'empty_header', 1 FROM w WHERE k % 7 = 0 UNION ALL SELECT k, 'empty_row', count(*) FROM f WHERE NOT head AND a = '' AND b = '' AND c IS NULL GROUP BY k)"""
_LEFT = r""", li AS (SELECT l_orderkey AS k, CASE WHEN l_suppkey % 5 = 0 THEN (l_partkey % 40) || 'e' || (l_linenumber % 3) ELSE printf('%d.%02d', l_partkey % 200, l_suppkey % 90 + 10) END AS t, l_linenumber % 4 AS n, l_partkey % 8 = 0 AS u, l_suppkey % 5 = 0 AS e FROM lineitem),
 src AS (SELECT k, t FROM li UNION ALL SELECT k, 'kV' FROM li WHERE u),
 dst AS (SELECT k, CASE WHEN n = 1 THEN '-' || t WHEN n = 2 AND e THEN t || '1' WHEN n = 2 THEN regexp_replace(t, '([0-9])\.([0-9])', '\1\2.') ELSE t END AS t FROM li WHERE n <> 3 UNION ALL SELECT k, 'kV' FROM li WHERE u AND n <> 2),
 d AS (SELECT k, t, CAST(sum(s) AS BIGINT) AS c FROM (SELECT k, t, 1 AS s FROM src UNION ALL SELECT k, t, -1 FROM dst) GROUP BY ALL HAVING c <> 0),
 x AS (SELECT k, t, abs(c) AS n, c > 0 AS src, regexp_extract(t, '^-?') AS sign, ltrim(t, '-') AS rest, nullif(regexp_extract(t, 'e([0-9]+)', 1), '') AS ex, ltrim(regexp_replace(regexp_replace(t, 'e.*$', ''), '[^0-9]', '', 'g'), '0') AS dg FROM d WHERE t <> 'kV'),
 p AS (SELECT a.k, a.t AS s, b.t AS o, a.n, b.n AS m, CASE WHEN a.rest = b.rest AND a.sign <> b.sign THEN 'sign_flip' WHEN a.ex IS NULL AND b.ex IS NULL AND a.rest <> b.rest AND a.rest NOT LIKE '%.' AND b.rest NOT LIKE '%.' THEN 'decimal_shift' WHEN a.dg <> '' AND a.ex IS DISTINCT FROM b.ex THEN 'exponent_change' END AS kind
   FROM x a JOIN x b ON a.k = b.k AND a.dg = b.dg AND a.src AND NOT b.src),
 z AS (SELECT *, sum(m) OVER (PARTITION BY k, s) AS ms, sum(n) OVER (PARTITION BY k, o) AS ns FROM p WHERE kind IS NOT NULL),
 fin AS (SELECT x.k, x.t AS source, z.o AS output, coalesce(z.kind, 'numeric_missing') AS kind, x.n FROM x LEFT JOIN (SELECT * FROM z WHERE ms = 1 AND ns = 1 AND n = 1 AND m = 1) z ON z.k = x.k AND z.s = x.t WHERE src
  UNION ALL SELECT k, t, NULL, 'unit_missing', c FROM d WHERE t = 'kV' AND c > 0)"""
ORACLE = {
    "table_grid": _GRID + ' SELECT k AS l_orderkey, "row", col, rowspan, colspan, header, text FROM g',
    "table_lint": _GRID + " SELECT k AS l_orderkey, problem, CAST(n AS BIGINT) AS n FROM pr",
    "table_pipes": _GRID + """, t AS (SELECT k, r, '| ' || a || ' | ' || b || ' |' AS line FROM f), h AS (SELECT k, r, CASE WHEN r = 0 THEN line || chr(10) || '| --- | --- |' ELSE line END AS line FROM t)
 SELECT k AS l_orderkey, string_agg(line, chr(10) ORDER BY r) AS markdown FROM h JOIN w USING (k) WHERE cols = 2 AND k % 19 <> 0 AND k % 23 <> 0 GROUP BY k""",
    "table_headers": _GRID + """, h AS (SELECT k, sha256(string_agg(text, ' ' ORDER BY col)) AS fingerprint FROM g WHERE "row" = 0 GROUP BY k) SELECT fingerprint, count(*) AS n, min(k) AS first FROM h GROUP BY fingerprint""",
    "numeric_reconcile": "WITH " + _LEFT[2:] + " SELECT k AS l_orderkey, source, output, kind, CAST(n AS BIGINT) AS n FROM fin",
    "table_statuses": _GRID + _LEFT + """, c AS (SELECT DISTINCT k FROM fin), q AS (SELECT DISTINCT k FROM pr)
 SELECT w.k AS l_orderkey, CASE WHEN w.k % 23 = 0 THEN 'visual_unscorable' WHEN w.k % 29 = 0 OR w.k % 31 = 0 THEN 'table_unscorable' WHEN q.k IS NOT NULL OR c.k IS NOT NULL THEN 'SUSPECT' ELSE 'OK' END AS status FROM w LEFT JOIN q USING (k) LEFT JOIN c USING (k)""",
}
