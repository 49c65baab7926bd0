"""Queries of the text functions over documents and pages, and the checks of a document's images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.sources.files import citations
from folioforge.sources.tables import table

#: How many replacement characters make a warning, and the marker of a picture that was left out.
GARBAGE, OMITTED = 10, "picture omitted"
EMBEDDED = r"data:image/[A-Za-z+.-]+;base64,"


def escapes(ref: Column) -> Column:
    """Whether a path leaves the folder it starts from, at any step, or is absolute."""
    depth = F.aggregate(F.split(ref, "/"), F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")), lambda s, x: F.struct(
        (s["at"] + F.when(x == "..", -1).when((x == ".") | (x == ""), 0).otherwise(1)).alias("at"), F.least(s["least"], s["at"] + F.when(x == "..", -1).otherwise(0)).alias("least")), lambda s: s["least"])
    return ref.startswith("/") | (depth < 0)


def asset_findings(docs: DataFrame, assets: DataFrame, key: str, md: str) -> DataFrame:
    """kind, file, n of a document's images: missing_asset (a local reference without a file), orphan_asset (a file without a
    reference), asset_path_escape and embedded_base64_asset. References elsewhere are left alone."""
    refs = docs.select(key, F.explode(T.image_refs(F.col(md))).alias("ref"))
    out = refs.where(F.col("ref").rlike("^" + EMBEDDED)).select(key, F.lit("embedded_base64_asset").alias("kind"), F.lit("").alias("file"))
    local = refs.where(T.is_local(F.col("ref"))).withColumn("_out", escapes(F.col("ref")))
    file = F.element_at(F.split(F.regexp_replace("ref", "[?#].*$", ""), "/"), -1)
    out = out.unionByName(local.where("_out").select(key, F.lit("asset_path_escape").alias("kind"), F.col("ref").alias("file")))
    # One pass over both sides instead of two anti joins.
    sides = local.where("NOT _out").select(key, file.alias("file"), F.lit(1).alias("ref"), F.lit(0).alias("own")).unionByName(assets.select(key, "file", F.lit(0).alias("ref"), F.lit(1).alias("own")))
    sums = sides.groupBy(key, "file").agg(F.max("ref").alias("ref"), F.max("own").alias("own")).where("ref <> own")
    out = out.unionByName(sums.select(key, F.when(F.col("ref") == 1, "missing_asset").otherwise("orphan_asset").alias("kind"), "file"))
    return out.groupBy(key, "kind", "file").agg(F.count(F.lit(1)).alias("n"))


def document_codes(md: Column) -> Column:
    """Codes of a document's text alone, errors first: file_empty ends the list; picture_omitted; base64_image; garbage_chars."""
    t = F.coalesce(md, F.lit(""))
    found = F.filter(F.array(F.when(F.contains(F.lower(t), F.lit(OMITTED)), "picture_omitted"), F.when(t.rlike(EMBEDDED), "base64_image"), F.when(F.length(t) - F.length(F.replace(t, F.lit("�"), F.lit(""))) >= GARBAGE, "garbage_chars")), lambda x: x.isNotNull())
    return F.when(~t.rlike(r"\S"), F.array(F.lit("file_empty"))).otherwise(found)


def _marked(spark, sf_dir):
    """Pages as Markdown: whole pages after images of their own, elsewhere, embedded, and above their folder."""
    k = F.col("page_id")
    own = F.format_string("![p](doc.assets/p%d.png) ![q](https://e.org/%d.png) ![r](notes.txt) ", k, k)
    more = F.concat(F.when(k % 5 == 0, "![b](data:image/png;base64,AAAA) ").otherwise(""), F.when(k % 7 == 0, F.format_string('<img alt="x" src="a/../../up/p%d.PNG"> ', k)).otherwise(""), F.when(k % 4 == 0, F.format_string("![p](doc.assets/p%d.png) ", k)).otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(own, more, F.coalesce("html", F.lit(""))).alias("md"))


def asset_problems(spark, sf_dir):
    pages = _marked(spark, sf_dir)
    name = F.format_string("p%d.png", "page_id")
    assets = pages.where("page_id % 6 <> 0").select("page_id", name.alias("file")).unionByName(pages.where("page_id % 6 = 1").select("page_id", F.concat(F.lit("copy_"), name).alias("file")))
    return asset_findings(pages, assets, "page_id", "md")


def references_moved(spark, sf_dir):
    moved = T.rewrite_refs(F.col("md"), "new.assets")
    return _marked(spark, sf_dir).select("page_id", F.sha2(moved, 256).alias("digest"))


def document_checks(spark, sf_dir):
    k = F.col("doc_id") % 9
    md = F.when(k == 0, " \n").when(k == 1, F.concat("text", F.lit(" Picture Omitted"))).when(k == 2, F.concat("text", F.lit("�" * 10))).when(k == 3, F.concat(F.lit("![](data:image/png;base64,x) picture omitted "), "text")).when(k == 4, F.concat("text", F.lit("�" * 9))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(document_codes(md), ",").alias("codes"))


def html_links(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">([^<]*)</a>'), F.lit(1))).alias("href"))
    return links.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


def page_citations(spark, sf_dir):
    """Citation rows put before and after whole pages, with nested tags, missing fields and rows of another kind."""
    row = lambda prop, n, title: F.concat(F.lit(f'<tr itemprop="{prop}" repeat>\n <td><span itemprop="publicationNumber">US'), "page_id", F.lit(f'{n}</span></td><td itemprop="priorityDate"> 1999-01-0{n} </td>'), F.lit(title), F.lit("</tr>"))
    html = F.concat(row("backwardReferences", 1, '<td itemprop="title"><b>A</b> thing</td>'), row("other", 2, ""), "html", row("backwardReferences", 3, '<span itemprop="assigneeOriginal">Corp</span>'))
    pages = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    out = citations(pages, "page_id", "html", "backwardReferences")
    return out.withColumn("country", T.country_of(F.col("number")))


def numeric_values(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(T.numeric_tokens(F.concat("text", F.lit(" 10² kV, 3–4 mm −2.5e3 1,234.5% 7×10^-2 5V/m x9 10⁻³")))).alias("value"))
    return docs.groupBy("doc_id", "value").agg(F.count(F.lit(1)).alias("n"))


def dollar_lines(spark, sf_dir):
    """Lines with an odd number of single dollars: those of the data, and some put in place of stops."""
    text = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit(". "), F.lit(" $5 "))).when(F.col("doc_id") % 3 == 1, F.replace("text", F.lit(", "), F.lit(" $$x$$ \\$ $y"))).otherwise(F.col("text"))
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(text, "\n")).alias("line", "t"))
    return lines.where(T.odd_dollars(F.col("t"))).select("doc_id", "line")


def document_claims(spark, sf_dir):
    """Whole texts with a marker put in after 50 characters of every third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.substring("text", 1, 50), F.lit(" We claim: "), F.expr("substring(text, 51)"))).otherwise(F.col("text")).alias("text"))
    return docs.select("doc_id", T.split_claims(F.col("text")).alias("s")).select("doc_id", F.length("s.before").alias("before"), F.sha2("s.claims", 256).alias("claims"))


def order_dates(spark, sf_dir):
    text = F.concat(F.lit("Date of Patent: "), F.date_format("o_orderdate", "MMM. d, yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.iso_date(F.when(F.col("o_orderkey") % 10 == 0, "Xyz. 1, 2000").otherwise(text)).alias("day"))


def squeezed_texts(spark, sf_dir):
    """Lengths of squeezed texts, and newline styles of texts whose newlines are kept, doubled, mixed, or lone."""
    k = F.col("doc_id") % 4
    lines = F.when(k == 1, F.replace("text", F.lit("\n"), F.lit("\r\n"))).when(k == 2, F.concat("text", F.lit("\r\nx"))).when(k == 3, F.concat("text", F.lit("\rx"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(T.squeeze(F.col("text"))).alias("n"), T.newline_style(lines).alias("newlines"))


def name_parts(spark, sf_dir):
    k = F.col("o_orderkey")
    stem = F.concat(F.when(k % 5 == 0, "doc").otherwise("us 0"), k.cast("string"), F.when(k % 3 == 0, "b2").otherwise("A"), F.when(k % 4 == 0, "_T1a_lead").when(k % 4 == 1, "_X_").when(k % 4 == 2, "_Xy").otherwise(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.number_from_name(stem).alias("number"), T.topic_of_name(stem).alias("topic"))


def formula_texts(spark, sf_dir):
    """Bodies, tags, fences and hard breaks of whole texts as formulas and code."""
    k = F.col("doc_id") % 3
    formula = F.when(k == 0, F.concat(F.lit(" $$ "), "text", F.lit("\\tag{3} $$ "))).when(k == 1, F.concat(F.lit("$$"), "text")).otherwise(F.col("text"))
    code = F.when(k == 0, F.concat("text", F.lit("````x`"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.strip_tags(T.formula_body(formula)), 256).alias("body"), F.md5(T.code_fence(code)).alias("fence"), F.length(T.hard_breaks(F.col("text"))).alias("hard"))


def incompatible_texts(spark, sf_dir):
    md = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("\\boldmath x"))).when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\\sum\\displaylimits \\boldmath"), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.incompatible_commands(md), ",").alias("commands"))


QUERIES = {f.__name__: f for f in (asset_problems, references_moved, document_checks, html_links, page_citations, numeric_values, dollar_lines, document_claims, order_dates, squeezed_texts, name_parts, formula_texts, incompatible_texts)}

_MD = r"""m AS (SELECT page_id, '![p](' || {0} || 'p' || page_id || '.png) ![q](https://e.org/' || page_id || '.png) ![r](notes.txt) ' || CASE WHEN page_id % 5 = 0 THEN '![b](data:image/png;base64,AAAA) ' ELSE '' END
 || CASE WHEN page_id % 7 = 0 THEN '<img alt="x" src="' || {1} || 'p' || page_id || '.PNG"> ' ELSE '' END || CASE WHEN page_id % 4 = 0 THEN '![p](' || {0} || 'p' || page_id || '.png) ' ELSE '' END || coalesce(html, '') AS md FROM pages)"""
ORACLE = {
    "asset_problems": """SELECT page_id, 'missing_asset' AS kind, 'p' || page_id || '.png' AS file, 1 AS n FROM pages WHERE page_id % 6 = 0 UNION ALL SELECT page_id, 'orphan_asset', 'copy_p' || page_id || '.png', 1 FROM pages WHERE page_id % 6 = 1
 UNION ALL SELECT page_id, 'embedded_base64_asset', '', 1 FROM pages WHERE page_id % 5 = 0 UNION ALL SELECT page_id, 'asset_path_escape', 'a/../../up/p' || page_id || '.PNG', 1 FROM pages WHERE page_id % 7 = 0""",
    "references_moved": "WITH " + _MD.format("'new.assets/'", "'new.assets/'") + " SELECT page_id, sha256(md) AS digest FROM m",
    "document_checks": """SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN 'file_empty' WHEN 1 THEN 'picture_omitted' WHEN 2 THEN 'garbage_chars' WHEN 3 THEN 'picture_omitted,base64_image' ELSE CASE WHEN regexp_matches(text, '\\S') THEN '' ELSE 'file_empty' END END AS codes FROM documents""",
    "html_links": """SELECT page_id, href, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href FROM pages) GROUP BY ALL""",
    "page_citations": """SELECT page_id, CAST(0 AS INTEGER) AS pos, 'US' || page_id || '1' AS number, '1999-01-01' AS priority, '' AS publication, '' AS assignee, 'A thing' AS title, 'US' AS country FROM pages WHERE html IS NOT NULL
 UNION ALL SELECT page_id, 1, 'US' || page_id || '3', '1999-01-03', '', 'Corp', '', 'US' FROM pages WHERE html IS NOT NULL""",
    "dollar_lines": r"""WITH d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, '. ', ' $5 ') WHEN 1 THEN replace(text, ', ', ' $$x$$ \$ $y') ELSE text END AS text FROM documents),
 l AS (SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM d))
 SELECT doc_id, CAST(line AS INTEGER) AS line FROM l WHERE len(list_filter(regexp_extract_all(replace(t, '\$', ''), '\$+'), lambda x: length(x) = 1)) % 2 = 1""",
    "order_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "document_claims": r"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN length(substr(text, 1, 50)) + 1 ELSE length(text) END AS before, CASE WHEN doc_id % 3 = 0 THEN sha256(regexp_replace(substr(text, 51), '^\s+', '')) END AS claims FROM documents""",
    "squeezed_texts": r"""SELECT doc_id, length(trim(regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+\n', chr(10), 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ')) AS n,
 CASE doc_id % 4 WHEN 0 THEN 'LF' WHEN 1 THEN CASE WHEN contains(text, chr(10)) THEN 'CRLF' ELSE 'LF' END WHEN 2 THEN CASE WHEN contains(text, chr(10)) THEN NULL ELSE 'CRLF' END END AS newlines FROM documents""",
    "name_parts": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'doc' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN 'b2' ELSE 'A' END || CASE o_orderkey % 4 WHEN 0 THEN '_T1a_lead' WHEN 1 THEN '_X_' WHEN 2 THEN '_Xy' ELSE '' END
  ELSE 'US' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN 'B2' ELSE 'A' END END AS number, CASE o_orderkey % 4 WHEN 0 THEN 'T1a_lead' WHEN 1 THEN 'X' WHEN 2 THEN 'Xy' ELSE '' END AS topic FROM orders""",
    "formula_texts": r"""WITH b AS (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN trim(text, ' ') WHEN 1 THEN trim('$$' || text, ' ') ELSE trim(text, ' ') END AS body, doc_id % 3 = 0 AS tagged FROM documents)
 SELECT doc_id, sha256(CASE WHEN tagged THEN ltrim(text, ' ') ELSE body END) AS body, md5(CASE WHEN tagged THEN '`````' || chr(10) || text || '````x`' || chr(10) || '`````' ELSE '```' || chr(10) || text || chr(10) || '```' END) AS fence, length(replace(text, chr(10), '  ' || chr(10))) AS hard FROM b""",
    "incompatible_texts": r"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '\boldmath' WHEN doc_id % 3 = 0 THEN '\displaylimits,\boldmath' ELSE '' END AS commands FROM documents""",
}
