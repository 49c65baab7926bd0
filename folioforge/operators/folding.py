"""Queries of the order-dependent text operations; each is an Arrow UDF over whole texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from folioforge.functions import folds
from folioforge.functions import text as T
from folioforge.sources.tables import DAMAGED, WORDS, by_document, damaged, table, words

#: A dictionary for rejoining: parts and wholes that the fixture splits.
KNOWN = frozenset({"the", "connection", "set", "screw", "setscrew", "with", "in"})


def _plain(spark, sf_dir):
    """Texts whose own dollars and backslashes are other signs, so that only those put in count."""
    return _docs(spark, sf_dir).withColumn("text", F.translate("text", "$\\", "§/"))


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def normalized_prose(spark, sf_dir):
    """Whole texts after a line of their own; a blank text leaves that line and the blank behind it."""
    line = " ﬁrst² ﬅ a‐b−c—d e f\n"
    f = folds.text_udf(lambda t: " ".join(folds.normalize_prose(x, True) for x in (line, t)), "string")
    return _docs(spark, sf_dir).select("doc_id", F.sha2(f(F.col("text")), 256).alias("digest"))


def rejoined_words(spark, sf_dir):
    f = folds.text_udf(lambda t: folds.rejoin_words(t, lambda w: w.lower() in KNOWN), "string")
    docs = _docs(spark, sf_dir).withColumn("text", F.concat(F.lit("a con nection by set screw, con  nection, con-nection; Con nection. "), F.regexp_replace("text", "en ", "en con nection. ")))
    return docs.select("doc_id", F.sha2(f(F.col("text")), 256).alias("digest"))


def claims_structured(spark, sf_dir):
    """Claims of whole texts: the first two are there, later ones where the text happens to hold their numbers."""
    f = folds.text_udf(lambda t: len(folds.structure_claims(t)), "int")
    body = F.regexp_replace("text", r"\. ", ". 3. ")
    docs = _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("claimed is: 1. A thing, 1.5 wide: a; b. 2. (The) thing of 1. "), F.when(F.col("doc_id") % 2 == 0, body).otherwise(F.col("text")), F.lit(" 4. Then 6. gap")).alias("text"))
    return docs.select("doc_id", f(F.col("text")).alias("claims"))


def _hyphenated(spark, sf_dir):
    word = F.when(F.col("ix") % 7 == 3, F.concat("word", F.lit("-"))).when(F.col("ix") % 11 == 5, F.concat("word", F.lit("‐"))).otherwise(F.col("word"))
    return words(table(spark, sf_dir, "documents")).withColumn("word", word)


def joined_words(spark, sf_dir):
    """Words of a page joined as adopted text."""
    f = F.pandas_udf(lambda s: s.map(folds.join_words), "string")
    pages = _hyphenated(spark, sf_dir).groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("ix", "word"))), lambda x: x["word"]).alias("w"))
    return pages.select("doc_id", "page", F.sha2(f("w"), 256).alias("digest"))


def math_stripped(spark, sf_dir):
    f = folds.text_udf(folds.strip_math, "string")
    marked = F.concat(F.lit("$x$ \\frac{a}{b{c}}\\cdot \\(y\\) z\\[\nw\\] "), F.replace("text", F.lit("e "), F.lit("e $a_1$ \\b{c}")), F.lit(" $open \\x"))
    return _plain(spark, sf_dir).select("doc_id", F.sha2(f(marked), 256).alias("digest"))


def latex_sanitized(spark, sf_dir):
    f = folds.text_udf(folds.sanitize_latex, "string")
    return _plain(spark, sf_dir).select("doc_id", F.sha2(f(F.concat(F.lit("\\upmu x_{{1}} \\displaylimits &lt;y}"), F.replace("text", F.lit("e "), F.lit("e \\pit ")))), 256).alias("digest"))


def token_consumption(spark, sf_dir):
    """Words of whole texts against damaged copies; every twentieth word is noise, some words hold two tokens."""

    def f(batches):
        for pdf in (whole.iloc[i : i + folds.SLICE] for whole in batches for i in range(0, len(whole), folds.SLICE)):
            got = [folds.consume_tokens([(w, i % 20 == 7) for i, w in enumerate((a or "").split())], b or "", T.CLAIMS) for a, b in zip(pdf["text"], pdf["output"], strict=True)]
            yield pdf[["doc_id"]].assign(**{k: pd.Series([x[k] for x in got], index=pdf.index, dtype="int64") for k in ("noise", "matched", "merged", "marker", "unexplained")})

    docs = by_document(_docs(spark, sf_dir)).withColumn("output", damaged(F.col("text"), F.col("doc_id"))).withColumn("text", F.concat(F.lit("What is claimed is: zzq "), "text"))
    return docs.mapInPandas(f, "doc_id long, noise long, matched long, merged long, marker long, unexplained long")


def _dollars(spark, sf_dir):
    """Texts with padded pairs, with lone dollars before numbers, and with tight pairs and a lone one at the end."""
    kind = F.col("doc_id") % 3
    marked = F.when(kind == 0, F.replace("text", F.lit("e "), F.lit("e $ q$ "))).when(kind == 1, F.replace("text", F.lit("n "), F.lit("n $5 "))).otherwise(F.concat(F.replace("text", F.lit("s "), F.lit("s $x$ ")), F.lit(" $a")))
    return _plain(spark, sf_dir).select("doc_id", marked.alias("text"))


def math_span_proposals(spark, sf_dir):
    f = folds.text_udf(lambda t: [{"lo": a, "hi": b, "replacement": c} for a, b, c in folds.whitespace_proposals(t)], "array<struct<lo: int, hi: int, replacement: string>>")
    return _dollars(spark, sf_dir).select("doc_id", F.inline(f(F.col("text")))).select("doc_id", "lo", "hi", F.md5("replacement").alias("replacement"))


def delimiter_events(spark, sf_dir):
    names = ("kind", "severity", "lo", "hi", "line", "column")
    f = folds.text_udf(lambda t: [dict(zip(names, x, strict=True)) for x in folds.delimiter_events(t)], "array<struct<kind: string, severity: string, lo: int, hi: int, line: int, column: int>>")
    return _dollars(spark, sf_dir).select("doc_id", F.inline(f(F.col("text"))))


def formula_suspicions(spark, sf_dir):
    f = folds.text_udf(lambda t: [{"kind": a, "what": b} for a, b, _ in folds.formula_suspicions(t)], "array<struct<kind: string, what: string>>")
    marked = F.replace(F.replace("text", F.lit("e "), F.lit("e \\int x ")), F.lit("n "), F.lit("n \\frac{a}{b'} \\sum\\limits_i \\frac{c}{d} "))
    rows = _plain(spark, sf_dir).select("doc_id", F.inline(f(marked)))
    return rows.groupBy("doc_id", "kind", "what").agg(F.count(F.lit(1)).alias("n"))


def headings_marked(spark, sf_dir):
    f = folds.text_udf(lambda t: folds.mark_headings(folds.strip_title(t, "A METHOD")), "string")
    marked = F.concat(F.lit("A METHOD\n\nFIELD OF\n\nTHE INVENTION\n\nA DBS\n\n"), "text", F.lit("\n\nSUMMARY The end"))
    return by_document(_docs(spark, sf_dir)).select("doc_id", F.regexp_count(f(marked), F.lit("(?m)^## ")).alias("headings"))


def cover_records(spark, sf_dir):
    f = folds.text_udf(folds.cover_fields, "struct<title: string, inventors: array<string>, assignee: string, date: string, classes: array<string>, abstract: string>")
    cover = F.concat(F.lit("(12) US (54) A "), F.substring_index("url", "/", -1), F.lit(": (75) Inventors: N"), "page_id", F.lit(" M, City; O P; (73) Assignee: Corp "), "page_id", F.lit(" (*) Notice (45) Date of Patent: Oct. "), (F.col("page_id") % 28 + 1).cast("string"), F.lit(", 2004 (51) A61N 1/05 A61N 1/05 (54) again (57) ABSTRACT  A  text"))
    return table(spark, sf_dir, "pages").select("page_id", f(cover).alias("c")).select("page_id", "c.title", F.array_join("c.inventors", "|").alias("inventors"), "c.assignee", "c.date", F.array_join("c.classes", "|").alias("classes"), "c.abstract")


QUERIES = {f.__name__: f for f in (normalized_prose, rejoined_words, claims_structured, joined_words, math_stripped, latex_sanitized, token_consumption, math_span_proposals, delimiter_events, formula_suspicions, headings_marked, cover_records)}

_DOLLARS = """t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, 'e ', 'e $ q$ ') WHEN 1 THEN replace(text, 'n ', 'n $5 ') ELSE replace(text, 's ', 's $x$ ') || ' $a' END AS text FROM (SELECT doc_id, translate(text, '$\\', '§/') AS text FROM documents))"""
ORACLE = {
    "normalized_prose": r"""SELECT doc_id, sha256('first2 st a-b-c—d e f ' || regexp_replace(trim(regexp_replace(text, '[\s\x0b]+', ' ', 'g'), ' '), '[‐‑‒–−]', '-', 'g')) AS digest FROM documents""",
    "rejoined_words": "SELECT doc_id, sha256('a connection by set screw, con  nection, con-nection; Connection. ' || replace(text, 'en ', 'en connection. ')) AS digest FROM documents",
    "claims_structured": r"""WITH RECURSIVE t AS (SELECT doc_id, trim(regexp_replace('claimed is: 1. A thing, 1.5 wide: a; b. 2. (The) thing of 1. ' || CASE WHEN doc_id % 2 = 0 THEN replace(text, '. ', '. 3. ') ELSE text END || ' 4. Then 6. gap', '\s+', ' ', 'g'), ' ') AS rest FROM documents),
 r AS (SELECT doc_id, 0 AS n, rest FROM t UNION ALL SELECT doc_id, n + 1, regexp_extract(rest, '^(?:|.*?\s)' || (n + 1) || '\.\s*([A-Z("].*)$', 1) FROM r WHERE regexp_matches(rest, '^(?:|.*?\s)' || (n + 1) || '\.\s*[A-Z("].*$'))
 SELECT doc_id, CAST(max(n) AS INTEGER) AS claims FROM r GROUP BY doc_id""",
    "joined_words": "WITH " + WORDS + r""", v AS (SELECT * REPLACE (CASE WHEN ix % 7 = 3 THEN word || '-' WHEN ix % 11 = 5 THEN word || '‐' ELSE word END AS word) FROM words),
 n AS (SELECT *, lag(word) OVER w AS b, lead(word) OVER w AS a FROM v WINDOW w AS (PARTITION BY doc_id, page ORDER BY ix)),
 s AS (SELECT *, coalesce(length(b) > 1 AND regexp_matches(b, '[-‐]$'), false) AS tied, length(word) > 1 AND regexp_matches(word, '[a-z][-‐]$') AND coalesce(regexp_matches(a, '^[a-z]'), false) AS soft FROM n)
 SELECT doc_id, page, sha256(nfc_normalize(string_agg(CASE WHEN b IS NULL OR tied THEN '' ELSE ' ' END || CASE WHEN soft THEN word[:-2] ELSE word END, '' ORDER BY ix))) AS digest FROM s GROUP BY ALL""",
    "math_stripped": r"""SELECT doc_id, sha256('   z ' || replace(translate(text, '$\', '§/'), 'e ', 'e  ') || ' ') AS digest FROM documents""",
    "latex_sanitized": r"""SELECT doc_id, sha256('\mu x_{1}  <y' || replace(translate(text, '$\', '§/'), 'e ', 'e \pi t ')) AS digest FROM documents""",
    "math_span_proposals": "WITH " + _DOLLARS + r""", p AS (SELECT doc_id, unnest(range(len(ps))) AS k, unnest(ps) AS part FROM (SELECT doc_id, string_split(text, '$') AS ps FROM t)),
 c AS (SELECT *, sum(length(part) + 1) OVER (PARTITION BY doc_id ORDER BY k) AS e, count(*) OVER (PARTITION BY doc_id) AS n FROM p)
 SELECT doc_id, CAST(e - length(part) - 2 AS INTEGER) AS lo, CAST(e AS INTEGER) AS hi, md5('$' || regexp_replace(regexp_replace(part, '^\s+', ''), '\s+$', '') || '$') AS replacement FROM c WHERE k % 2 = 1 AND k < n - 1 AND (regexp_matches(part, '^\s') OR regexp_matches(part, '\s$'))""",
    "delimiter_events": "WITH " + _DOLLARS + r""", l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS l FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM t)),
 b AS (SELECT *, coalesce(sum(length(l) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM l),
 p AS (SELECT doc_id, line, base, unnest(range(len(ps))) AS k, unnest(ps) AS part FROM (SELECT *, string_split(l, '$') AS ps FROM b)),
 c AS (SELECT *, sum(length(part) + 1) OVER (PARTITION BY doc_id, line ORDER BY k) AS e, count(*) OVER (PARTITION BY doc_id, line) AS n FROM p)
 SELECT doc_id, 'inline_math_delimiter_whitespace' AS kind, 'P1' AS severity, CAST(base + e - length(part) - 2 AS INTEGER) AS lo, CAST(base + e AS INTEGER) AS hi, CAST(line AS INTEGER) AS line, CAST(e - length(part) - 1 AS INTEGER) AS "column" FROM c WHERE k % 2 = 1 AND k < n - 1 AND (regexp_matches(part, '^\s') OR regexp_matches(part, '\s$'))
 UNION ALL SELECT doc_id, CASE WHEN m THEN 'ambiguous_currency_delimiter' ELSE 'unpaired_math_delimiter' END, CASE WHEN m THEN 'P2' ELSE 'P1' END, CAST(base + e - length(part) - 2 AS INTEGER), CAST(base + e - length(part) - 1 AS INTEGER), CAST(line AS INTEGER), CAST(e - length(part) - 1 AS INTEGER)
 FROM (SELECT *, regexp_matches(part, '^[0-9]+([.,][0-9]+)?(\s|$)') AS m FROM c WHERE k % 2 = 1 AND k = n - 1)""",
    "formula_suspicions": r"""WITH c AS (SELECT doc_id, (length(text) - length(replace(text, 'e ', ''))) // 2 AS e, (length(replace(text, 'e ', 'e \int x ')) - length(replace(replace(text, 'e ', 'e \int x '), 'n ', ''))) // 2 AS n FROM (SELECT doc_id, translate(text, '$\', '§/') AS text FROM documents))
 SELECT doc_id, 'bare_op' AS kind, '\int' AS what, e AS n FROM c WHERE e > 0 UNION ALL SELECT doc_id, 'frac_primed_denom', 'frac÷b''', n FROM c WHERE n > 0""",
    "headings_marked": r"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: trim(regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', ''))), lambda x: x <> '') AS ps FROM documents),
 f AS (SELECT doc_id, ps, list_transform(ps, lambda x: NOT regexp_matches(x, '[a-z]') AND regexp_matches(x, '\p{L}')) AS caps FROM p)
 SELECT doc_id, CAST(2 + len(list_filter(range(2, len(ps) + 1), lambda i: caps[i] AND NOT caps[i - 1] AND len(string_split(ps[i], ' ')) >= 3 AND length(ps[i]) >= 12)) AS INTEGER) AS headings FROM f""",
    "cover_records": r"""SELECT page_id, trim('A ' || regexp_extract(url, '([^/]*)$', 1), ' .,:;') AS title, 'N' || page_id || ' M|O P' AS inventors, 'Corp ' || page_id AS assignee, '2004-10-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS "date", 'A61N1/05' AS classes, 'A text' AS abstract FROM pages""",
}
