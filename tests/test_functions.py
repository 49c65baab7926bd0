"""Behaviour of single functions on a few rows."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.functions import folds
from folioforge.functions import text as T
from folioforge.operators import classify, coverage, geometry, ordered, repair, tables
from folioforge.sources import files, sinks
from folioforge.streaming import pages


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(("core", "known", "kind"), [
    ("ringS", True, "casing"), ("CaSOS", False, "mixedcase"), ("2002fO116029", False, "numjoin"), ("rings", True, None), ("RINGS", True, None), ("McCabe", False, None),
    ("LEDs", False, None), ("MHz", True, None), ("eECAP", False, None), ("6286B2", False, None),
])
def test_garble(spark, core, known, kind):
    assert one(spark, classify.garble(F.col("a"), F.lit(known)), a=core) == kind


def test_error_bucket_prefers_garbled_tag(spark):
    assert one(spark, classify.error_bucket(F.col("a"), F.col("b")), a="text mode", b="\\tag{3_1}") == "tag_garble"
    assert one(spark, classify.error_detail(F.col("a")), a="Undefined control sequence: \\upmu") == "\\upmu"


def test_gate_stops_repetition_and_reorder(spark):
    gate = classify.similarity_gate(F.col("a"), F.col("b"))
    for new, old, want in (("x x x x", "x y z w", "overlap"), ("c b a", "a b c", "pure_reorder"), ("a b c d", "a b c", None), ("a-b", "a+b", None), ("X", "x", "overlap"), ("$x$", "x", None), ("x_i", "x", None),
                           ("x^2+x-y+1", "x", "new_tokens"), ("a" * 40, "a", "length_ratio"), ("rate limit", "x", "degenerate_error_text"), (" ", "x", "degenerate_empty"), ("x", "", None), ("$ $", "x", "empty")):
        assert one(spark, gate, a=new, b=old) == want, (new, old)


def test_edit_share_counts_code_points(spark):
    assert one(spark, coverage.edit_share(F.col("a"), F.col("b")), a="é", b="e") == 1.0
    assert one(spark, coverage.edit_share(F.col("a"), F.col("b")), a="", b="") == 0.0


def test_claims_and_dates(spark):
    got = one(spark, T.split_claims(F.col("a")), a="Text. We claim: 1. A thing")
    assert (got["before"], got["claims"]) == ("Text. ", "1. A thing")
    assert one(spark, T.iso_date(F.col("a")), a="Oct. 5, 2004") == "2004-10-05"
    assert one(spark, T.iso_date(F.col("a")), a="nothing") == ""


def test_inid_first_value_wins(spark):
    assert one(spark, T.inid_fields(F.col("a")), a="x (54) Title (75) Me (54) Other") == {"54": "Title", "75": "Me"}


def test_numbers_keep_exponents(spark):
    assert one(spark, T.numeric_tokens(F.col("a")), a="10² is 102 not −3.5 or 2e5") == ["10^2", "102", "-3.5", "2e5"]


def test_images(spark):
    assert one(spark, T.rewrite_refs(F.col("a"), "d.assets"), a="![p](x/y.png \"t\") ![q](https://e/z.png) <IMG src='a/b/c.JPG?v=1'> ![n](x/y.txt)") == "![p](d.assets/y.png \"t\") ![q](https://e/z.png) <IMG src='d.assets/c.JPG'> ![n](x/y.txt)"
    assert one(spark, T.tight_math(F.col("a")), a="$ x $ y") == "$x$ y"
    assert one(spark, T.newline_style(F.col("a")), a="a\r\nb\nc") is None
    assert one(spark, T.code_fence(F.col("a")), a="```x").startswith("````\n")


def test_folds():
    known = {"connection", "combination", "set", "screw", "screws", "setscrew", "implant", "able", "implantable"}
    for text, want in (("a con nection.", "a connection."), ("a combina tion of", "a combination of"), ("set screw set screws", "set screw set screws"), ("an implant able", "an implant able"), ("con, nection con  nection", "con, nection con  nection"), ("com bina tion", "com bina tion")):
        assert folds.rejoin_words(text, lambda w: w.lower() in known) == want
    assert folds.join_words(["deter-", "mined", "X-", "ray", "-", "a", "b\u00ad", "c", "É-", "x"]) == "deter-mined X-ray - a bc É-x".replace("deter-mined", "determined")
    assert folds.structure_claims("is: 1. A x comprising: a; b including: c; d 2. (B) of 1. 4. D") == [(1, "1. A x comprising:\n   - a\n   - b including:\n   - c\n   - d"), (2, "2. (B) of 1. 4. D")]
    assert folds.structure_claims("none") == [] and folds.structure_claims("1. A. 2.5 mm 2. b 2. C")[1][1] == "2. C"
    assert folds.strip_math("a $x$ \\frac{a}{b{c}}d \\(y\\)e\\[z\\]f \\b{open") == "a  d ef "
    assert folds.strip_math_tokens("a 10² b×c d") == "a d"
    for bad, good in (
        ("\\upmu x_{{1}} \\ensuremath{y}}", "\\mu x_{1} y"), ("a&lt;b $c\\$", "a<b c\\$"), ("x\\displaylimits \\displaystyle", "x \\displaystyle"), ("1/\\pit_r \\pitchfork", "1/\\pi t_r \\pitchfork"), ("\\cdotd x \\cdot y", "\\cdot d x \\cdot y"),
        ("{a\\atop b\\atop c}", "{\\substack{a\\\\b\\\\c}}"), ("{a\\atop b}", "{a\\atop b}"), ("{a\\atopwithdelims b\\atop c}", "{a\\atopwithdelims b\\atop c}"), ("V_g_{\\max} x_1", "V_{g\\ \\max} x_1"), ("x^\\prime^2 y^{a}^{b}", "x^{\\prime 2} y^{a\\ b}"), ("x_a^b", "x_a^b"),
        ("\\quad_{x}", "\\quad{}_{x}"), ("\\frac{\\displaystyle\\int}\\alpha", "{\\displaystyle\\int}\\alpha"), ("\\begin{array}{c}a&b\\\\c\\end{array}", "\\begin{array}{cc}a&b\\\\c\\end{array}"), ("\\left[\\begin{array}{c}a\\right]_{n}", "\\left[\\begin{array}{c}a\\end{array}\\right]_{n}"),
        ("\\left.x\\right.", "x"), ("\\left(x", "(x"), ("x\\right)", "x)"), ("\\quad\\left.k", "\\quad k"), ("\\omega\\leftarrow\\sigma", "\\omega\\leftarrow\\sigma"), ("\\left(x\\right)", "\\left(x\\right)"), ("a}b\\}", "ab\\}"), ("{a}}", "{a}"),
        ("5 dBி", "5 dBi"), ("①®", "\\text{\\textcircled{1}}\\text{\\textregistered}"), ("\\text{\\textregistered}", "\\text{\\textregistered}"), ("\\text{172^{\\circ}C}", "172^{\\circ}\\text{C}"), ("\\text{a \\ln Z}", "\\text{a }\\ln \\text{ Z}"), ("\\text{max}", "\\text{max}"),
        ("x电压y\\text{电}", "x\\text{电压}y\\text{电}"), ("\\mathrm{电}", "\\mathrm{\\text{电}}"),
        ("\\left|\\begin{matrix}b\\\\\\displaystyle\\int f d x\\\\a\\end{matrix}\\right|", "\\left|\\int_{a}^{b} f d x\\right|"),
    ):
        assert folds.sanitize_latex(bad) == good, bad
    assert folds.last_json_array('noise [1] then [{"a": 1}] end') == [{"a": 1}]
    assert folds.whitespace_proposals("$ x $ \\$5 $y$ $$ z $$") == [(0, 5, "$x$")] and folds.tighten("a $ x $ $  $ $$ y $$") == "a $x$ $  $ $$ y $$"
    assert folds.delimiter_events("a $ x$\nb $5 c\n$$d$$ \\$ $e") == [("inline_math_delimiter_whitespace", "P1", 2, 6, 1, 3), ("ambiguous_currency_delimiter", "P2", 9, 10, 2, 3), ("unpaired_math_delimiter", "P1", 23, 24, 3, 10)]
    assert folds.formula_suspicions("\\int x \\int_0 \\sum\\limits^n \\lim \\frac{a}{c'} \\intercal \\frac{a}{b}") == [("bare_op", "\\int", 0), ("bare_op", "\\lim", 28), ("frac_primed_denom", "frac÷c'", 33)]
    assert folds.formula_suspicions("$$ \\overrightarrow{\\nabla}\\times \\int d\\overrightarrow{a} = \\oint d\\overrightarrow{l} $$") == []
    assert folds.normalize_prose("ﬁ‐x  y ﬅ —", True) == "fi-x y st —"
    assert folds.numeric_tokens("10² kV 3–4 −2.5e3 1,234.5% 7×10^-2 5 mm 6V/m 8 °C x9 10⁻³") == ["10^2", "kV", "3–4", "-2.5e3", "1,234.5%", "7×10^-2", "5", "6", "V/m", "8", "°C", "10^-3"]
    assert folds.numeric_values("|x|² 10²", title=True) == ["2", "10^2"]
    for text, want in (("3 . 5", "3 . 5"), ("2\\times 10^{−12}", "2× 10^-12"), ("x10+3", "x10^3"), ("16{,}0", "16.0"), ("1e-5 2.5E+3", "10^-5 2.5×10^3"), ("\\le0.44 5\\%", "≤0.44 5%"), ("–5 –3 %", "-5 -3%"), ("— 7 —", ""), ("3µTabc", "3µT abc"), ("1,234 1,23", "1,234 1.23")):
        assert folds.canonical_numbers(text) == want, text
    assert folds.diff_runs(["a", "b"], ["a", "c"]) == (["b"], ["c"])
    assert folds.map_changes(["a\nb\n", "c\nd\n"], "a\nB\n\n\nc\nd\n") == {0: "a\nB\n"} and folds.map_changes(["a\n", "b\n"], "x\n\n\ny\n") == {0: "x\n", 1: "y\n"} and folds.map_changes(["a\n", "b\n"], "a\nb\n") is None
    assert folds.mark_headings("FIELD\n\nOF THE INVENTION\n\ntext\n\nA DBS\n\nSUMMARY The end\n\nA DBS system") == "## Field Of The Invention\n\ntext\n\nA DBS\n\n## Summary\n\nThe end\n\nA DBS system"
    assert folds.strip_title("A METHOD\n\nCROSS REFERENCE\n\nx", "A Method") == "CROSS REFERENCE\n\nx" and folds.clean_markdown("a  b \n\n\n\n   c") == "a b\n\n c"
    assert folds.yaml_header({"title": 'a "b"', "names": ["x"], "none": []}) == "---\ntitle: \"a 'b'\"\nnames:\n  - \"x\"\nnone: []\n---"


def literal_consumption(source, output):
    """Every word against counts of the output's tokens, one after another."""
    have = {}
    for t in re.findall("[a-z0-9]+", output.lower()):
        have[t] = have.get(t, 0) + 1
    first = dict(have)
    out = []
    for word, noise in source:
        own = re.findall("[a-z0-9]+", word.lower())
        if noise or not own:
            out.append("noise" if noise else None)
        elif all(have.get(t, 0) for t in own):
            for t in own:
                have[t] -= 1
            out.append("matched")
        else:
            out.append("merged" if all(have.get(t, 0) > 0 or (len(t) > 2 and any(t in m for m in first if len(m) > 3)) for t in own) else "left")
    return out


def test_token_consumption_against_a_literal_walk(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()
    r = random.Random(3)
    for d in docs:
        words = [(w, r.random() < 0.1) for w in d["text"].split()]
        output = " ".join(w for w, _ in words if r.random() < 0.8).replace("e ", "e")
        want = literal_consumption(words, output)
        got = folds.consume_tokens(words, output)
        assert (got["noise"], got["matched"], got["merged"], got["unexplained"]) == tuple(want.count(k) for k in ("noise", "matched", "merged", "left"))
    assert folds.consume_tokens([("What", False), ("is", False), ("claimed", False), ("zz", False)], "", ("I claim", "What is claimed is")) == {"noise": 0, "matched": 0, "merged": 0, "marker": 3, "unexplained": 1}


def test_numbers_of_both_engines_agree(spark, sf):
    r = random.Random(5)
    bits = ["1", "23", "4.5", ",", "678", "²", "⁻", "¹", "e", "E", "x", "×", "10", "^", "-", "−", "–", "+", "%", " ", " ", "kV", "mm", "°C", "V/m", "A", "µ", ".", "~"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(1, 14))) for _ in range(4000)] + [x["text"] for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in df.select("i", T.numeric_tokens(F.col("t")).alias("n")).collect():
        assert row["n"] == folds.numeric_tokens(texts[row["i"]]), texts[row["i"]]


def test_table_grid_spans_and_lint():
    t = tables.parse("<table><caption> a  b</caption><tr><td rowspan=2>A</td><td>B</td></tr><tr><td>C</td></tr><tr><td colspan=2>D $x<y$</td></tr></table>")
    assert [(x[0], x[1], x[5]) for x in t.cells] == [(0, 0, "A"), (0, 1, "B"), (1, 1, "C"), (2, 0, "D $x<y$")] and (t.roots, t.rows, t.cols, t.caption) == (1, 3, 2, "a b") and tables.problems(t) == [] and tables.pipes(t) is None
    codes = lambda html: [x[0] for x in tables.problems(tables.parse(html))]
    assert codes("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>") == ["grid_hole"]
    assert codes("") == codes("text") == codes("<table></table>") == ["empty_table"]
    for span in ("²", "-1", "x", "", "1000000000", "99999999999999999999"):
        assert codes(f'<table><tr><td rowspan="{span}" colspan="{span}">a</td></tr></table>') == ["invalid_span"]
    assert codes("<table><tr><td rowspan=3>a</td></tr></table>") == ["invalid_span"]
    assert codes("<td>x</td><table><td>y</td><tr><th></th></tr><tr><td> </td></tr></table><table></table>") == ["multiple_table_roots", "orphan_cell", "empty_header", "empty_row"]
    assert "overlapping_cells" in codes("<table><tr><td>a</td><td rowspan=2>b</td></tr><tr><td colspan=2>c</td></tr></table>")
    pipe = lambda body: tables.pipes(tables.parse(f"<table>{body}</table>"))
    assert pipe("<caption>c|d</caption><tr><th>a</th><th>b</th></tr><tr><td>x|y $ z $</td></tr>") == "*c\\|d*\n\n| a | b |\n| --- | --- |\n| x\\|y $z$ |  |"
    assert pipe("<tr><td>a<sup>2</sup></td></tr>") is None and pipe("<tr><td>$|x|$</td></tr>") is None and pipe("<tr><td><table></table></td></tr>") is None and pipe("<tr><td>a</td></tr>") is not None
    head = lambda body: tables.header_fingerprint(tables.parse(f"<table>{body}</table>"))
    assert head("<tr><th>ﬁ x</th></tr><tr><td>1</td></tr>") == head("<thead><tr><td>fi  x</td></tr></thead><tr><td>2</td></tr>") != head("<tr><th>y</th></tr>")


def test_reconciliation_pairs_only_what_is_unique(spark):
    source, output = ["12.5", "7", "7", "3e2", "4", "kV", "-5", "0.60", "90"], ["-12.5", "70", "3e5", "4", "5", "6.0", "9", "0.9"]
    df = lambda xs: spark.createDataFrame([(1, x) for x in xs], "k long, token string")
    got = {r["source"]: (r["output"], r["kind"], r["n"]) for r in tables.reconcile_numbers(df(source), df(output), "k").collect()}
    assert got == {"12.5": ("-12.5", "sign_flip", 1), "7": (None, "numeric_missing", 2), "3e2": ("3e5", "exponent_change", 1), "kV": (None, "unit_missing", 1), "-5": ("5", "sign_flip", 1), "0.60": ("6.0", "decimal_shift", 1), "90": (None, "numeric_missing", 1)}


def test_arbitration(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    text = "0123456789"
    rows = [(1, 1, 0, 5, "a"), (1, 2, 3, 8, "a"), (2, 1, 0, 5, "a"), (2, 2, 0, 5, "a"), (3, 1, 5, 5, "a"), (3, 2, 5, 5, "b"), (4, 1, 0, 5, "a"), (4, 2, 3, 3, "b"), (4, 3, 5, 9, "c"), (5, 1, 0, 5, "a"), (5, 2, 0, 5, "b"), (5, 3, 0, 5, "a"),
            (6, 1, 5, 11, "a"), (6, 2, -1, 2, "a"), (6, 3, 4, 2, "a"), (7, 1, 0, 4, "a"), (7, 2, 3, 7, "b"), (7, 3, 6, 9, "c"), (7, 4, 9, 10, "d"), (8, 1, 5, 5, "a"), (8, 2, 5, 5, "a"), (9, 1, 0, 3, "stale")]
    df = spark.createDataFrame([(d, i, lo, hi, "x" if r == "stale" else sha(text[lo:hi]), r) for d, i, lo, hi, r in rows], "doc long, id long, lo long, hi long, before string, replacement string")
    docs = spark.createDataFrame([(d, text) for d in range(1, 10)], "doc long, text string")
    got = {(r["doc"], r["id"]): r["verdict"] for r in ordered.interval_conflicts(df, docs).collect()}
    over, range_ = "overlapping_proposals", "target_out_of_range"
    assert got == {(1, 1): over, (1, 2): over, (2, 1): "kept", (2, 2): "duplicate", (3, 1): "shared_insertion_anchor", (3, 2): "shared_insertion_anchor", (4, 1): "kept", (4, 2): "kept", (4, 3): "kept", (5, 1): over, (5, 2): over, (5, 3): "duplicate",
                   (6, 1): range_, (6, 2): range_, (6, 3): range_, (7, 1): over, (7, 2): over, (7, 3): over, (7, 4): "kept", (8, 1): "kept", (8, 2): "duplicate", (9, 1): "target_fingerprint_mismatch"}


def test_accepted_correction_is_not_hidden(spark):
    blocks = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, content string")
    fp = lambda t: hashlib.sha256(t.encode()).hexdigest()[:16]
    fixes = spark.createDataFrame([(1, 1, "A", fp("a"), "accepted"), (1, 2, "X", fp("a"), "rejected"), (2, 1, "B", fp("b"), "accepted"), (2, 2, "C", "stale", "accepted"), (3, 1, "D", fp(""), "accepted")], "k long, seq int, corrected string, stored string, status string")
    assert {r["k"]: (r["content"], r["applied"]) for r in repair.apply_corrections(blocks, fixes, ["k"]).collect()} == {1: ("A", True), 2: ("b", False), 3: ("D", True)}


def test_chunks_count_on_through_parts_of_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("k"), (F.col("id") * 7919 % 100_003).alias("x"))
    got = {(r["k"], r["x"]): r["rank"] for r in ordered.ranks(df, "k", "x").collect()}
    for k in ("hot", "cold"):
        xs = sorted(x for key, x in got if key == k)
        assert [got[k, x] for x in xs] == list(range(len(xs)))


def test_counts_add_up_with_one_key_or_none(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("a", 2)] * 3 + [("a", 3), ("b", None)], "k string, v int")
    got = lambda keys, n: sorted(map(tuple, ordered.bounded_counts(df, keys, "v", n).collect()), key=str)
    assert got(["k"], 2) == [("a", "1", 5), ("a", "2", 3), ("a", "__other__", 1), ("b", None, 1)] and got([], 1) == [("1", 5), ("__other__", 5)]


def test_lines_do_not_depend_on_row_order(spark):
    rows = [(1, i, float(i % 3 * 10 + i * 0.1), float(i % 3 * 10 + i * 0.1 + 4)) for i in range(9)]
    df = spark.createDataFrame(rows, "page long, ix int, y0 double, y1 double")
    a = sorted(map(tuple, geometry.group_lines(df, ["page"], F.lit(3.0)).collect()))
    b = sorted(map(tuple, geometry.group_lines(df.orderBy(F.desc("ix")), ["page"], F.lit(3.0)).collect()))
    assert a == b and {x[2] for x in a} == {0, 1, 2}


def test_unknown_status_is_an_error(spark):
    with pytest.raises(ValueError):
        repair.set_status(spark.range(1).withColumn("status", F.lit("pending")), {"id": 0}, "wrong")
    for key, found in ((0, True), (7, False)):
        rows, matched = repair.set_status(spark.range(1).withColumn("status", F.lit("pending")), {"id": key}, "accepted")
        assert matched == found and rows.first()["status"] == ("accepted" if found else "pending")


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"x")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "A.pdf").write_bytes(b"y")
    assert files.documents(spark, [str(tmp_path)]).count() == 2
    with pytest.raises(Exception, match="stem"):
        files.documents(spark, [str(tmp_path)], unique_stems=True).collect()
    (tmp_path / "p.json").write_text(json.dumps({"width": 1.0, "parsing_res_list": [{"block_label": "text", "block_id": 3}]}))
    (tmp_path / "q.json").write_text("{broken")
    assert [r["block_id"] for r in files.page_blocks(spark, str(tmp_path / "*.json")).collect()] == [3]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n[1]\nnot json\n{"a": 2}\n')
    assert [r["a"] for r in files.json_lines(spark, str(tmp_path / "l.jsonl"), "a int").orderBy("seq").collect()] == [1, 2]
    df = spark.createDataFrame([("x", "p"), ("y", "p"), ("z", "q")], "id string, kind string")
    assert {r["item"]: r["n"] for r in sinks.write_findings(df, str(tmp_path / "out"), "kind", 1).collect()} == {"p": 2, "__other__": 1}
    sinks.write_report(df, str(tmp_path / "report"), "Findings")
    assert "| x | p |" in "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "report")).collect())


def test_stream_runs_each_file_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.range(3).write.mode("append").parquet(src)
    pages.run_available(spark, src, "id long", out, ck, lambda df: df.withColumn("twice", F.col("id") * 2))
    spark.range(3, 5).write.mode("append").parquet(src)
    pages.run_available(spark, src, "id long", out, ck, lambda df: df.withColumn("twice", F.col("id") * 2))
    assert sorted(r["twice"] for r in spark.read.parquet(out).collect()) == [0, 2, 4, 6, 8]


def test_poison_pages_are_left(spark):
    p = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "doc long, page long")
    bad = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "doc long, page long")
    assert [r["page"] for r in pages.to_do(p, p.where("page = 1"), bad, ["doc", "page"]).collect()] == [3]
