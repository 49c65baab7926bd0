"""Queries against their SQL on tables made for one odd input each, and what their plans may not do."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from test_oracle import ORACLE, QUERIES, rows

from folioforge.functions import folds
from folioforge.operators import classify, geometry, ordered, repair, tables
from folioforge.sources import tables as sources


@pytest.fixture
def agree(spark, tmp_path):
    def run(name, texts):
        spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        c = duckdb.connect()
        c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert rows(QUERIES[name](spark, str(tmp_path)).toPandas()) == rows(c.sql(ORACLE[name]).df())
    return run


def test_formula_ends_in_a_run_of_dollars(agree):
    agree("formula_texts", {1: "Raes*** cimición&&& ragaó.$$$", 2: "$$$ a$$$", 3: "a$$$", 4: "$$$"})


def test_blank_text_is_normalised(agree):
    agree("normalized_prose", {1: "", 2: " \n", 3: " a  b\n", 4: None})


def test_capitals_keep_the_length(agree):
    agree("similarity_gates", {4: "ßölich", 44: "a b", 114: "Zuenheit ßölich einchst tzbech.", 94: "ß", 184: "Zuenheit ßölich einchst tzbech."})


@pytest.mark.parametrize("name", ["noise_words", "page_paragraphs", "composed_bodies", "front_pages", "page_medians", "page_kind", "line_groups", "page_health_words", "reading_targets"])
def test_words_are_not_shuffled(spark, sf, name, monkeypatch):
    """Texts are dealt once, by document; pages and lines of words need no further exchange (texts of lines are dealt once more)."""
    monkeypatch.setattr(sources, "PART", 10000)
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"(?<![A-Za-z])Exchange (.*?)\(?(?:, \d+\)|\n)", plan)
    assert dealt and all(re.fullmatch(r"hashpartitioning\(doc_id#\d+L?", x) for x in dealt), dealt


def test_plain_markup_is_read_alike():
    """The direct reader of tables against the general one, on random markup."""
    rng = random.Random(5)
    pieces = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<td colspan=2>", "<th rowspan=0 colspan=3>", "</th>", "<thead>", "</thead>", "<caption>", "</caption>", "a > b", " x\n", "7", "<td rowspan=2000>"]
    for _ in range(3000):
        html = "<table>" + "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        direct, general = tables._Reader(), tables._Reader()
        assert direct.plain(html)
        general.feed(html)
        general.close()
        assert (direct.out, direct.rows, direct.heads) == (general.out, general.rows, general.heads)
    assert not any(tables._Reader().plain(x) for x in ("<b>", "a & b", "$x$", "<td class=a>", "<!-- -->", "<TD>"))


def test_owner_spans_of_odd_ends(spark):
    frags = spark.createDataFrame([(1, [1, 2], 0, 5), (1, [1], 0, 5), (1, [3], 0, None), (1, [4], 0, 5), (1, [4], 0, None), (1, [5], None, 9), (1, [6], 1, 2), (1, [6], 1, 3)], "page long, block_ids array<int>, span_start int, span_end int")
    refs = spark.createDataFrame([(1, i) for i in range(1, 8)], "page long, block_id int")
    got = {r["block_id"]: (r["span_start"], r["span_end"], r["route"] == "ok") for r in repair.resolve_owner(refs, frags, ["page"]).collect()}
    assert got == {1: (0, 5, True), 2: (0, 5, True), 3: (0, None, True), **{i: (None, None, False) for i in (4, 5, 6, 7)}}


def test_lower_case_is_never_garbled(spark):
    """What pages_to_read() sorts out beforehand."""
    rng = random.Random(3)
    cores = ["".join(rng.choices("abzäß019", k=rng.randint(1, 9))) for _ in range(500)]
    df = spark.createDataFrame([(c, k) for c in cores if not re.search("[0-9]{4}", c) for k in (True, False)], "c string, k boolean")
    assert df.where(classify.garble(F.col("c"), F.col("k")).isNotNull()).isEmpty()


def test_spans_of_one_text_are_judged_as_in_the_table(spark):
    """The judgement inside a row (repair_loop) against that of interval_conflicts()."""
    rng = random.Random(12)
    text, plans = "aäbc€defghij" * 4, {}
    for doc in range(300):
        spans = []
        for _ in range(rng.randint(1, 6)):
            lo = rng.randint(-1, 47)
            hi = lo + rng.choice([0, 0, 1, 2, 5, -1])
            spans.append((lo, hi, hashlib.sha256(("x" if rng.random() < 0.1 else text[max(lo, 0) : max(hi, 0)]).encode()).hexdigest(), rng.choice("xy")))
        plans[doc] = spans
    df = spark.createDataFrame([(d, i, *s) for d, spans in plans.items() for i, s in enumerate(spans)], "doc long, id long, lo long, hi long, before string, replacement string")
    told = {(r["doc"], r["id"]): r["verdict"] for r in ordered.interval_conflicts(df, spark.createDataFrame([(d, text) for d in plans], "doc long, text string")).collect()}
    assert {(d, i): v for d, spans in plans.items() for i, v in enumerate(folds.span_verdicts(text, spans))} == told


def test_repairs_move_no_text(spark, tmp_path):
    """Texts are dealt once; their proposals are judged and applied where they lie."""
    texts = [(k, f"See the $ x $ side. {k}") for k in range(6)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = QUERIES["repaired_documents"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(?<![A-Za-z])Exchange (?!hashpartitioning\(doc_id#)", plan), plan


@pytest.mark.parametrize("name", ["word_block_assign", "removal_checks"])
def test_words_meet_what_is_said_of_their_page_unmoved(spark, sf, name, monkeypatch):
    """Words, blocks, sizes and notes of a page meet in one aggregate: words are dealt with their document, and not once more by page."""
    monkeypatch.setattr(sources, "PART", 10000)
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"(?<![A-Za-z])Exchange (.*?)\(?(?:, \d+\)|\n)", plan)
    assert dealt and not any(re.fullmatch(r"hashpartitioning\(doc_id#\d+L?, page#\d+", x) for x in dealt), dealt


def test_words_between_odd_blocks(spark):
    """Blocks that tie, touch or miss; a page without blocks, one without a size, one that cannot be scored; a word without a place."""
    words = spark.createDataFrame([(p, i, *b) for p in (1, 2, 3, 4) for i, b in enumerate([(0.0, 0.0, 2.0, 2.0), (9.0, 0.0, 12.0, 2.0), (5.0, 5.0, 5.0, 6.0), (50.0, 50.0, 51.0, 51.0), (None, 0.0, 1.0, 1.0)])], "page int, ix int, x0 double, y0 double, x1 double, y1 double")
    blocks = spark.createDataFrame([(p, i, *b) for p in (1, 3, 4) for i, b in enumerate([(0.0, 0.0, 10.0, 10.0), (0.0, 0.0, 4.0, 4.0), (0.0, 0.0, 4.0, 4.0), (11.0, 0.0, 30.0, 9.0)])], "page int, source_index int, x0 double, y0 double, x1 double, y1 double")
    sizes = spark.createDataFrame([(1, False), (2, False), (4, True)], "page int, unscorable boolean").select("*", *(F.lit(100.0).alias(c) for c in ("pdf_width", "pdf_height", "ocr_width", "ocr_height")))
    got = {(r["page"], r["ix"]): r["source_index"] for r in geometry.assign_words(words, blocks, ["page"], sizes=sizes).collect()}
    assert got == {(p, i): v if p == 1 else None for p in (1, 2, 3, 4) for i, v in enumerate([1, None, 0, None, None])}
    plain = {(r["page"], r["ix"]): r["source_index"] for r in geometry.assign_words(words, blocks, ["page"]).where("page <> 2").collect()}
    assert plain == {(p, i): v for p in (1, 3, 4) for i, v in enumerate([1, None, 0, None, None])}


@pytest.mark.parametrize("name", ["page_medians", "page_health_words", "page_kind"])
def test_parts_grow_with_the_table(spark, tmp_path, name, monkeypatch):
    """What a task sorts is bounded: four times the table is dealt in four times the parts, whatever number the session has for shuffles."""
    monkeypatch.setattr(sources, "PART", 10000, raising=False)
    rng, parts = random.Random(14), []
    for n in (200, 800):
        texts = [(k, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(100))) for k in range(n)]
        spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/{n}/documents.parquet")
        plan = QUERIES[name](spark, f"{tmp_path}/{n}")._jdf.queryExecution().executedPlan().toString()
        parts.append({int(x) for x in re.findall(r"(?<![A-Za-z])Exchange hashpartitioning\([^()]*, (\d+)\)", plan)})
    assert all(len(p) == 1 for p in parts), parts
    assert 3.5 < max(parts[1]) / max(parts[0]) < 4.5 and max(parts[0]) > 8, parts
