"""Readers, sinks, stores, streams and loops on a few files and rows."""

import json
import logging

import pytest
from pyspark.sql import functions as F

from folioforge.functions import folds
from folioforge.operators import findings, prose
from folioforge.sources import extracted, files, sinks
from folioforge.streaming import pages


def test_words_of_both_readings_and_fonts(spark, tmp_path):
    word = lambda t, i: {"x0": 1.0 * i, "y0": 2.0, "x1": 3.0, "y1": 4.0, "text": t, "block_no": 0, "line_no": i // 2, "word_no": i % 2}
    page = {"doc": "a", "page": 0, "width": 612.0, "height": 792.0, "text": "b c", "words": [word("b", 0), word("  ", 1), word("c", 2)], "baseline": [word("bc", 0)],
            "fonts": [{"xref": 1, "name": "F", "type": "Type0", "has_tounicode": None}, {"xref": 2, "name": "G", "type": "Type0", "has_tounicode": False}]}
    (tmp_path / "w.json").write_text(json.dumps(page) + "\n{broken\n" + json.dumps({**page, "page": 1, "words": None, "text": None, "fonts": []}) + "\n")
    path = str(tmp_path / "w.json")
    assert [(r["page"], r["ix"], r["word"], r["line_no"], r["word_no"]) for r in extracted.page_words(spark, path).collect()] == [(0, 0, "b", 0, 0), (0, 2, "c", 1, 0)]
    assert [(r["word"], r["extractor"]) for r in extracted.page_words(spark, path, "baseline").where("page = 0").collect()] == [("bc", "baseline")]
    assert [(r["page"], r["text"]) for r in extracted.page_sources(spark, path).orderBy("page").collect()] == [(0, "b c"), (1, "")]
    fonts = extracted.page_fonts(spark, path)
    assert [r["has_tounicode"] for r in fonts.orderBy("xref").collect()] == [None, False]
    assert prose.missing_tounicode(fonts, ["doc", "page"]).first()["suspected"] and not prose.missing_tounicode(fonts.where("xref = 1"), ["doc", "page"]).first()["suspected"]


def test_documents_are_sorted_and_others_skipped(spark, tmp_path, caplog):
    for name in ("b.pdf", "a.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    with caplog.at_level(logging.WARNING):
        got = [r["stem"] for r in files.documents(spark, [str(tmp_path), str(tmp_path / "c.txt")]).collect()]
    assert got == ["a", "b"] and "c.txt" in caplog.text and files.documents(spark, [str(tmp_path / "c.txt")]).count() == 0


def test_corrections_carry_the_fingerprint_of_their_bytes(spark, tmp_path):
    import hashlib

    raw = json.dumps({"corrections": [{"page": 1, "status": "accepted"}, {"page": 2, "status": "pending"}]}).encode()
    (tmp_path / "x_corrections.json").write_bytes(raw)
    rows = files.corrections(spark, str(tmp_path), "STRUCT<page INT, status STRING>").orderBy("seq").collect()
    assert [(r["seq"], r["page"], r["status"]) for r in rows] == [(0, 1, "accepted"), (1, 2, "pending")] and {r["fingerprint"] for r in rows} == {hashlib.sha256(raw).hexdigest()}


def test_annotations_name_their_file_and_dictionaries_hold_words(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"a{i}.json").write_text(json.dumps({"annotations": [{"page": i}]}))
    assert sorted((r["file"].rsplit("/", 1)[1], r["page"]) for r in files.annotations(spark, str(tmp_path / "a*.json"), "STRUCT<page INT>").collect()) == [("a1.json", 1), ("a2.json", 2)]
    (tmp_path / "d.txt").write_text("Word\nword\n x1 \n\nÄpfel\n")
    assert sorted(r["word"] for r in files.dictionary(spark, str(tmp_path / "d.txt")).collect()) == ["word", "äpfel"]


def test_packages_must_be_whole_and_agree(spark, tmp_path):
    def make(root, folder, own, extra=True):
        (tmp_path / root / folder).mkdir(parents=True)
        (tmp_path / root / folder / "package.json").write_text(json.dumps({"package_id": own}))
        if extra:
            (tmp_path / root / folder / "data.txt").write_text("x")

    make("good", "p1", "p1"), make("good", "p2", "p2"), make("wrong", "p1", "p2"), make("part", "p1", "p1", False)
    need = ["package.json", "data.txt"]
    assert sorted(r["package_id"] for r in files.checked_packages(spark, str(tmp_path / "good"), need).collect()) == ["p1", "p2"]
    for root in ("wrong", "part"):
        with pytest.raises(Exception, match="package"):
            files.checked_packages(spark, str(tmp_path / root), need).collect()


def test_pages_are_replaced_by_document(spark, tmp_path):
    path = str(tmp_path / "pages")
    sinks.write_pages(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "doc string, page int, md string"), path, "doc")
    sinks.write_pages(spark.createDataFrame([("a", 2, "z")], "doc string, page int, md string"), path, "doc")
    assert sorted((r["doc"], r["page"], r["md"]) for r in spark.read.parquet(path).collect()) == [("a", 2, "z"), ("b", 1, "y")]


def test_a_store_goes_back_and_leaves_out_what_is_stale_or_damaged(spark, tmp_path):
    path = str(tmp_path / "store")
    df = lambda md: spark.createDataFrame([("a", 1, "k1", md), ("a", 2, "k2", None)], "doc string, page int, cache_key string, markdown string")
    assert (sinks.store_pages(df("one"), path), sinks.store_pages(df("two"), path)) == (0, 1)
    text = lambda **kw: [r["markdown"] for r in sinks.read_stored_pages(spark, path, **kw).orderBy("page").collect()]
    assert text() == ["two", None]
    sinks.roll_back(spark, path, 0)
    assert text() == ["one", None]
    assert text(expected=spark.createDataFrame([("a", 1, "k1"), ("a", 2, "other")], "doc string, page int, cache_key string")) == ["one"]
    with pytest.raises(ValueError):
        sinks.roll_back(spark, path, 7)
    assert sinks.store_pages(df("three"), path) == 2 and text() == ["three", None]
    bad = spark.read.parquet(f"{path}/records/version=2").withColumn("markdown", F.lit("changed"))
    bad.write.parquet(f"{path}/records/version=3")
    sinks._point(spark, path, 3)
    assert text() == []


def test_reports_keep_order_over_many_parts(spark, tmp_path):
    df = spark.range(500).select((499 - F.col("id")).alias("n"), F.lit("a|b").alias("t")).repartition(7)
    sinks.write_report(df, str(tmp_path / "r"), "Title")
    lines = [line for f in sorted((tmp_path / "r").glob("part-*")) for line in f.read_text().splitlines()]
    assert lines[:5] == ["# Title", "", "| n | t |", "|---|---|", "| 0 | a\\|b |"] and len(lines) == 504 and lines[-1].startswith("| 499 ")


def test_restarts_are_bounded():
    results = iter(["FAILED", "FAILED", "SUSPECT"])
    assert pages.run_until_done(lambda: next(results)) == ("SUSPECT", 2)
    calls = []
    assert pages.run_until_done(lambda: calls.append(1) or "FAILED", 3) == ("FAILED", 3) and len(calls) == 4


def test_only_whole_documents_are_skipped(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    manifests = df([("a", "f", 150, 2), ("b", "f", 150, 2), ("c", "old", 150, 1), ("d", "f", 300, 1), ("e", "f", 150, 2)], "doc string, fingerprint string, dpi int, page_count int")
    wanted = df([(d, "f", 150) for d in "abcdex"], "doc string, fingerprint string, dpi int")
    done = df([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 1)], "doc string, page int")
    assert sorted(r["doc"] for r in pages.finished(manifests, wanted, done, df([("e", 2), ("e", 1)], "doc string, page int")).collect()) == ["a", "e"]


def test_watermarked_windows(spark, tmp_path):
    rows = spark.sql("SELECT timestamp'2024-01-01 00:10:00' AS ts, 'a' AS k, 2.0D AS value UNION ALL SELECT timestamp'2024-01-01 00:50:00', 'a', 3.0D UNION ALL SELECT timestamp'2024-01-01 03:00:00', 'b', 1.0D")
    rows.write.parquet(str(tmp_path / "in"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    pages.run_available(spark, str(tmp_path / "in"), "ts timestamp, k string, value double", out, ck, lambda df: pages.windowed_counts(df, "ts", "k"))
    assert [(r["k"], r["n"], r["total"]) for r in spark.read.parquet(out).collect()] == [("a", 2, 5.0)]


def test_detectors_are_tagged_and_may_not_collide(spark):
    rows = spark.createDataFrame([(1, "m"), (2, "m")], "page int, message string")
    got = findings.collect({"b": rows, "a": rows}, ["page"]).collect()
    assert len({r["finding_id"] for r in got}) == 4 and {r["capability"] for r in got} == {"a", "b"}
    with pytest.raises(Exception, match="duplicate"):
        findings.collect({"a": rows.union(rows)}, ["page"]).collect()


def test_loops_stop_for_each_reason(spark):
    docs = spark.createDataFrame([("fix", "a b"), ("clean", "x"), ("gate", "g b"), ("stuck", "s"), ("p0", "p b"), ("clash", "c b"), ("slow", "b b b")], "doc string, text string")
    sha = lambda c: F.sha2(c, 256)
    found = lambda d: d.where("contains(text, 'b') OR text = 's'").select("doc", F.when(F.col("doc") == "p0", "P0").otherwise("P1").alias("severity"))

    def propose(d):
        at = (F.instr("text", "b") - 1).cast("long")
        base = d.where("contains(text, 'b')").select("doc", F.lit(1).cast("long").alias("id"), at.alias("lo"), (at + 1).alias("hi"), sha(F.lit("b")).alias("before"), F.when(F.col("doc") == "gate", "$").otherwise("B").alias("replacement"))
        return base.unionByName(base.where("doc = 'clash'").withColumn("id", F.lit(2).cast("long")).withColumn("replacement", F.lit("Q")))

    got = {r["doc"]: (r["text"], r["applied"], r["rounds"], r["stop"]) for r in findings.repair_loop(docs, found, propose, 2).collect()}
    assert got == {"fix": ("a B", 1, 1, "resolved"), "clean": ("x", 0, 1, "resolved"), "gate": ("g b", 0, 1, "rolled_back"), "stuck": ("s", 0, 1, "no_progress"), "p0": ("p b", 0, 1, "no_progress"), "clash": ("c b", 0, 1, "no_progress"), "slow": ("B B b", 2, 2, "max_rounds")}


def test_arrays_are_checked_strictly():
    fields = {"id": str, "confidence": (int, float)}
    good = [{"id": "a", "confidence": 1}, {"id": "b", "confidence": 0.5}]
    assert folds.valid_rows(good, fields) == good and folds.valid_rows([], fields) == []
    for bad in (None, [1], [{"id": "a"}], [{"id": "a", "confidence": True}], [{"id": 1, "confidence": 1}], [{"id": "a", "confidence": 1, "more": 1}]):
        assert folds.valid_rows(bad, fields) is None
    assert folds.last_json_array("x [1, 2] y [[3]] z [broken") == [[3]] and folds.last_json_array("none") is None
