"""From signals to repairs: one event a block, answers of models to corrections and proposals, worklists, reviews, viewer rows."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import folds
from folioforge.operators.geometry import by_slices, indices, meeting, pairs_at, ragged
from folioforge.operators.repair import default_gates, failed_gate, fingerprint
from folioforge.plans.session import reuse
from folioforge.sources.tables import WORDS, by_document, table, words

#: Fixed value: states of an event that are final.
TERMINAL = ("resolved", "ignored", "accepted", "rejected")
#: Where a capability's events go; what is not listed is blocked.
ROUTES = {"formulas": "formula_agent", "final_delimiters": "deterministic:final_delimiters", "source_audit": "quality_agent:block", "unordered_blocks": "quality_agent:block", "assets": "blocker:assets", "page_completeness": "blocker:rerun"}


def canonical(*fields: Column) -> Column:
    """SHA-256 of named fields as JSON in the order of their names, nulls included."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def formula_events(candidates: DataFrame, renders: DataFrame, blocks: DataFrame, page: list[str]) -> DataFrame:
    """One event a formula block that a candidate (block_id, reasons, crop_path, fresh, state) or a render record (block_ids, level,
    fresh) names: P1 with a render error, else P2; reasons and crops distinct and sorted; counts of records.

    Stale records and candidates that are settled play no part, nor do blocks that do not exist. The identity is the block's
    content, not what is said about it.
    """
    open_ = candidates.where(F.col("fresh") & ~F.coalesce(F.col("state").isin(*TERMINAL), F.lit(False)))
    none = F.array().cast("array<string>")
    one = open_.select(*page, F.col("block_id").cast("long").alias("block_id"), F.coalesce("reasons", none).alias("reasons"), F.when(F.col("crop_path") != "", F.array("crop_path")).otherwise(none).alias("crops"), F.lit("candidate").alias("kind"))
    two = renders.where("fresh").select(*page, F.explode(F.col("block_ids").cast("array<bigint>")).alias("block_id"), none.alias("reasons"), none.alias("crops"), F.col("level").alias("kind"))
    sums = one.unionByName(two).groupBy(*page, "block_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("reasons")))).alias("reasons"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("crops")))).alias("crops"),
        F.count_if(F.col("kind") == "candidate").alias("candidates"), F.count_if(F.col("kind") == "errors").alias("errors"), F.count_if(F.col("kind") == "warnings").alias("warnings"))
    rows = sums.join(blocks.select(*page, F.col("block_id").cast("long").alias("block_id"), "label", "content"), [*page, "block_id"])
    own = canonical(F.col("block_id"), F.col("content"), F.col("label"))
    return rows.select(*page, "block_id", F.when(F.col("errors") > 0, "P1").otherwise("P2").alias("severity"), F.lit(ROUTES["formulas"]).alias("route"), own.alias("input_fingerprint"), "reasons", "crops", "candidates", "errors", "warnings")


def collect(detectors: dict[str, DataFrame], identity: list[str]) -> DataFrame:
    """Findings of all detectors, each with its capability and an id over capability and identity; two with one id are an error."""
    out = None
    for name, rows in sorted(detectors.items()):
        tagged = rows.withColumn("capability", F.lit(name)).withColumn("finding_id", F.substring(canonical(F.col("capability"), *map(F.col, sorted(identity))), 1, 20))
        out = tagged if out is None else out.unionByName(tagged)
    n = F.count(F.lit(1)).over(Window.partitionBy("finding_id"))
    return out.withColumn("finding_id", F.when(n > 1, F.raise_error(F.concat(F.lit("duplicate finding "), "finding_id"))).otherwise(F.col("finding_id")))


def route_of(capability: Column) -> Column:
    """Where an event of a capability goes; a blocker where no rule says."""
    routes = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])
    return F.coalesce(F.try_element_at(routes, capability), F.concat(F.lit("blocker:"), F.coalesce(capability, F.lit("unknown"))))


def bare_formula(latex: Column) -> Column:
    """Without up to three layers of outer math marks."""
    out = F.trim(F.coalesce(latex, F.lit("")))
    for _ in range(3):
        out = F.trim(F.regexp_replace(F.trim(F.regexp_replace(out, r"^(?:\$\$|\\\[|\$)", "")), r"(?:\$\$|\\\]|\$)$", ""))
    return out


def to_corrections(answers: DataFrame, candidates: DataFrame, status: str = "accepted") -> DataFrame:
    """Correction rows of answers (candidate_id, verdict, latex, confidence, provider, model, attempt): only `correct` makes one, and
    only for a candidate that exists. Carries the fingerprint of the text it corrects and where it came from."""
    rows = answers.where("verdict = 'correct'").join(candidates, "candidate_id")
    engine = F.coalesce("engine_latex", F.lit(""))
    return rows.select("page", "block_id", F.array_join("reasons", "+").alias("kind"), engine.alias("engine_latex"), F.concat(F.lit("$$ "), bare_formula(F.col("latex")), F.lit(" $$")).alias("corrected_latex"),
                       F.concat_ws(":", F.lit("agent"), "provider", "model").alias("source"), "confidence", fingerprint(engine).alias("content_fingerprint"), F.lit(status).alias("status"), "candidate_id", "attempt")


def to_proposals(decisions: DataFrame, findings: DataFrame, docs: DataFrame) -> DataFrame:
    """Proposals of decisions (finding_id, verdict, md_start, md_end, replacement, ...): a repair whose span lies in its finding's
    (owner_start, owner_end), which lies in the document; with the fingerprint of what it replaces. Others make none."""
    rows = decisions.where("verdict = 'repair'").join(findings.select("finding_id", "doc", "owner_start", "owner_end"), "finding_id").join(docs.select("doc", "text"), "doc")
    inside = (F.col("owner_start") >= 0) & (F.col("owner_start") <= F.col("md_start")) & (F.col("md_start") <= F.col("md_end")) & (F.col("md_end") <= F.col("owner_end")) & (F.col("owner_end") <= F.length(F.coalesce("text", F.lit(""))))
    before = F.substring(F.coalesce("text", F.lit("")), (F.col("md_start") + 1).cast("int"), (F.col("md_end") - F.col("md_start")).cast("int"))
    return rows.where(inside).select("doc", "finding_id", "md_start", "md_end", F.sha2(before, 256).alias("before_fingerprint"), "replacement", F.concat_ws(":", F.lit("agent"), "provider", "model").alias("producer"), "confidence")


def block_repairs(decisions: DataFrame, findings: DataFrame) -> DataFrame:
    """Corrections of repairs whose page and block are those of a finding grounded in the source."""
    rows = decisions.where("verdict = 'repair'").select("finding_id", F.col("page").alias("_p"), F.col("block_id").alias("_b"), "replacement").join(findings.where("source_grounded"), "finding_id")
    return rows.where((F.col("page") > 0) & (F.col("page") == F.col("_p")) & (F.col("block_id") == F.col("_b"))).select("finding_id", "page", "block_id", "replacement")


def decision_status(verdict: Column, has_repair: Column) -> Column:
    return F.when(verdict == "accept", "ignored").when((verdict == "repair") & has_repair, "accepted").when(verdict == "repair", "repair_unapplied").when(verdict == "novel", "novel_confirmed").otherwise("uncertain")


def repair_worklist(suspicions: DataFrame, renders: DataFrame, page: list[str]) -> DataFrame:
    """Blocks of a page that a heuristic (block_id, kind, op) or a render error (block_id) names, once each, with all kinds and operators
    and the name of their crop."""
    hits = suspicions.select(*page, "block_id", "kind", "op").unionByName(renders.select(*page, "block_id", F.lit("render_error").alias("kind"), F.lit(None).cast("string").alias("op")))
    out = hits.groupBy(*page, "block_id").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.array_sort(F.collect_set("op")).alias("ops"))
    return out.withColumn("crop", F.format_string("page_%04d_block_%s.png", F.col(page[-1]).cast("int"), F.col("block_id").cast("string")))


def check_notes(notes: DataFrame, pages: DataFrame, error_pages: DataFrame, blocks: DataFrame, page: list[str]) -> DataFrame:
    """Whether each note (category, bbox, note) on a rebuilt page holds now: 1 no render error is left on its page; 3 its text is in the
    page's Markdown; 4 the first block around its centre has the label it names; others are for a person (null)."""
    packed = blocks.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("source_index", "label", "x0", "y0", "x1", "y1"))).alias("_b"))
    rows = notes.join(pages.select(*page, "md"), page, "left").join(error_pages.select(*page).distinct().withColumn("_e", F.lit(True)), page, "left").join(packed, page, "left")
    x, y = (F.get("bbox", F.lit(0)) + F.get("bbox", F.lit(2))) / 2, (F.get("bbox", F.lit(1)) + F.get("bbox", F.lit(3))) / 2
    under = F.get(F.filter("_b", lambda b: (b["x0"] <= x) & (x <= b["x1"]) & (b["y0"] <= y) & (y <= b["y1"])), F.lit(0))["label"]
    want = F.trim(F.coalesce("note", F.lit("")))
    found = F.when(F.col("category") == 1, F.col("_e").isNull()).when(F.col("category") == 3, (want != "") & F.coalesce(F.contains("md", want), F.lit(False))).when(F.col("category") == 4, (want != "") & F.coalesce(under == want, F.lit(False)))
    return rows.select(*notes.columns, found.alias("ok"))


def check_removals(notes: DataFrame, words: DataFrame, kinds: DataFrame, md_tokens: DataFrame, page: list[str]) -> DataFrame:
    """Verdict of notes on words that were cut or kept (note_id, cat, bbox, resolution, kind): skipped where it was set aside; manual where
    it is a region or of another sort; failed where the page does not exist or is no text; wrong_del passes where a word kept
    there has its tokens in the document's Markdown (document, token), missed_del where a word there was removed.

    A page's notes and words meet in one row; only the tokens that then decide meet those of the document.
    """
    doc = page[0]
    cat = lambda n: n["cat"].isin("wrong_del", "missed_del") & (F.coalesce(n["kind"], F.lit("")) != "region")
    word = F.struct("ix", "word", F.col("removed").cast("double").alias("removed"), ((F.col("x0") + F.col("x1")) / 2).cast("double").alias("xc"), ((F.col("y0") + F.col("y1")) / 2).cast("double").alias("yc"))
    pages = meeting(page, _n=(notes, F.struct("note_id", "cat", "bbox", "resolution", "kind")), _w=(words, word), _k=(kinds, F.col("kind"))).where(F.size("_n") > 0)
    pages = pages.select(*page, "_n", F.sort_array("_w").alias("_w"), F.coalesce(F.get("_k", F.lit(0)), F.lit("")).alias("_kind"))

    @F.arrow_udf("array<int>")
    def first_word(*columns: pa.Array) -> pa.Array:
        lists = [ragged(c) for c in columns]
        out = []
        for k in range(len(columns[0])):
            x = [v[ends[k] : ends[k + 1]] for ends, v in lists]
            out.append(pairs_at(_first_inside, len(x[0]), x[:5], x[5:]))
        return indices(out)

    side = lambda i: F.transform("_n", lambda n: F.get(n["bbox"], F.lit(i)).cast("double"))
    wanted = F.transform("_n", lambda n: F.when(cat(n), (n["cat"] == "missed_del").cast("double")))
    pages = pages.withColumn("_at", first_word(*map(side, range(4)), wanted, "_w.xc", "_w.yc", "_w.removed"))
    at = lambda i: F.get(F.col("_w.word"), F.get("_at", i))
    text = F.col("_kind").isin("SPEC_BODY", "FRONT_MATTER")
    tokens = lambda w: F.array_distinct(F.regexp_extract_all(F.lower(w), F.lit("[a-z0-9]+"), F.lit(0)))
    asks = lambda n, i: cat(n) & text & (n["cat"] == "wrong_del") & F.get("_at", i).isNotNull() & ~F.coalesce(n["resolution"].isin("wontfix", "invalid"), F.lit(False))
    code = lambda n, i: F.when(n["resolution"].isin("wontfix", "invalid"), 0).when(~F.coalesce(cat(n), F.lit(False)), 1).when(text & F.get("_at", i).isNotNull(), 2).otherwise(3)
    told = F.transform("_n", lambda n, i: F.struct(i.alias("_i"), n["note_id"].alias("note_id"), code(n, i).alias("_c"), F.when(asks(n, i), tokens(at(i))).otherwise(F.array().cast("array<string>")).alias("_t")))
    note = F.struct(*page[1:], "_i", "note_id", "_c")
    asked = pages.select(*page, F.inline(told)).select(doc, F.explode_outer("_t").alias("token"), note.alias("_n"))
    own = md_tokens.where(F.col("token").isNotNull()).select(doc, "token").distinct()
    met = asked.unionByName(own.withColumn("_in", F.lit(1)), allowMissingColumns=True).groupBy(doc, "token").agg(F.max("_in").alias("_in"), F.collect_list("_n").alias("_n"))
    met = met.select(doc, (F.col("token").isNull() | F.col("_in").isNotNull()).alias("_ok"), F.inline("_n"))
    verdict = F.element_at(F.array(*map(F.lit, ("skipped", "manual", "passed", "failed"))), F.when((F.col("_c") == 2) & ~F.col("_ok"), 3).otherwise(F.col("_c")) + 1)
    return met.groupBy(*page, "_i", "note_id").agg(F.max("_c").alias("_c"), F.bool_and("_ok").alias("_ok")).select(*page, "note_id", verdict.alias("verdict"))


def _first_inside(notes: list[np.ndarray], words: list[np.ndarray]) -> np.ndarray:
    """First word whose centre is in a note's box, with a slack of one, and that was removed or not as the note says; -1 for none."""
    (a, b, c, d, wanted), (xc, yc, removed) = notes, words
    hit = (xc >= a - 1) & (xc <= c + 1) & (yc >= b - 1) & (yc <= d + 1) & (removed == wanted)
    return np.where(hit.any(axis=1), hit.argmax(axis=1), -1)


def model_review(answers: DataFrame, root: DataFrame, runs: DataFrame, confirmed: DataFrame | None = None) -> DataFrame:
    """Items of a benchmark with the groups of their models' answers (item, model, pos, class, latex): item, groups, models, disagreement.

    Only valid runs (model, valid) count, and one whose items are not the root's, in its order, is an error. Groups are of class and
    formula without outer marks and white space, the root's first, then by size, then by formula. Models disagree where
    there is not one group, or it is not the root's; with confirmed errors (model, item) only those answers are shown.
    """
    ids = lambda df, by: df.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda s: s["item"]).alias("_ids"))
    expected = root.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda s: s["item"]).alias("_want"), F.lit(1).alias("_one"))
    fine = ids(answers.join(runs.where("valid").select("model"), "model"), ["model"]).withColumn("_one", F.lit(1)).join(expected, "_one")
    fine = fine.select("model", F.when(F.col("_ids") == F.col("_want"), True).otherwise(F.raise_error(F.concat(F.lit("items out of order: "), "model"))).alias("_fine")).where("_fine")
    rows = answers.join(fine.select("model"), "model")
    if confirmed is not None:
        rows = rows.join(confirmed.select("model", "item").distinct(), ["model", "item"])
    bare = lambda c: F.regexp_replace(bare_formula(c), r"\s+", "")
    own = root.select("item", F.col("class").alias("_rc"), bare(F.col("latex")).alias("_rl"))
    groups = rows.withColumn("formula", bare(F.col("latex"))).groupBy("item", "class", "formula").agg(F.array_sort(F.collect_set("model")).alias("supporters")).join(own, "item")
    groups = groups.withColumn("is_root", (F.col("class") == F.col("_rc")) & (F.col("formula") == F.col("_rl")))
    w = Window.partitionBy("item")
    groups = groups.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("is_root"), F.desc(F.size("supporters")), "formula", "class")))
    apart = F.lit(True) if confirmed is not None else (F.col("n") != 1) | ~F.col("is_root")
    return groups.select("item", "rank", "class", "formula", "is_root", "supporters", apart.alias("disagreement"))


def view_rows(blocks: DataFrame, audits: DataFrame, corrections: DataFrame, candidates: DataFrame, page: list[str], most: int = 3) -> DataFrame:
    """One row a block for a viewer: its box if it has one, place and head; its audit with at most `most` samples a side and whether
    there were more; a correction whose fingerprint is that of the present text, whatever its state; a candidate."""
    box = F.when(F.coalesce(F.size("bbox") == 4, F.lit(False)), F.col("bbox"))
    cut = lambda c: F.slice(F.coalesce(c, F.array().cast("array<string>")), 1, most)
    more = lambda c: F.coalesce(F.size(c), F.lit(0)) > most
    rows = blocks.join(audits.select(*page, "block_id", "content_source", "missing", "added"), [*page, "block_id"], "left")
    rows = rows.join(corrections.select(*page, "block_id", F.struct("status", "corrected_latex").alias("_c"), F.col("content_fingerprint").alias("_f")), [*page, "block_id"], "left").join(candidates.select(*page, "block_id", "candidate_id"), [*page, "block_id"], "left")
    fresh = F.col("_f") == fingerprint(F.col("content"))
    return rows.select(*page, "block_id", "label", box.alias("bbox"), F.col("block_order").alias("order"), F.substring(F.coalesce("content", F.lit("")), 1, 120).alias("head"), "content_source", cut(F.col("missing")).alias("missing"), more(F.col("missing")).alias("missing_truncated"),
                       cut(F.col("added")).alias("added"), more(F.col("added")).alias("added_truncated"), F.when(fresh, F.col("_c")).alias("correction"), "candidate_id")


#: Fixed value: texts with their proposals that are Python objects at a time.
TEXTS = 64


def repaired(text: Column, spans: Column) -> Column:
    """folds.repaired() of a text and its array of spans."""
    kind = pa.struct([("text", pa.string()), ("n", pa.int32())])

    @F.arrow_udf("struct<text: string, n: int>")
    def run(texts: pa.Array, lo: pa.Array, hi: pa.Array, before: pa.Array, new: pa.Array) -> pa.Array:
        return by_slices(lambda t, *xs: None if xs[0] is None else folds.repaired(t, list(zip(*xs, strict=True))), kind, texts, lo, hi, before, new, rows=TEXTS)

    return run(text, spans["lo"], spans["hi"], spans["before"], spans["replacement"])


def repair_loop(docs: DataFrame, detect, propose, rounds: int = 2) -> DataFrame:
    """Audit, propose, apply and audit again, document by document (doc, text): doc, text, applied, rounds, stop.

    detect(docs) gives (doc, severity); propose(docs) gives (doc, id, lo, hi, before, replacement). A round applies a
    document's surviving proposals at once, unless one conflicts (as interval_conflicts tells) or it has a P0 finding, and only if every
    gate passes. A document stops where nothing is found any more (resolved), a gate failed (rolled_back), a round changed nothing
    (no_progress), or after the last round (max_rounds). Only the number of open documents reaches the driver.

    A document's text meets its proposals in one row, where they are judged and applied: where docs are dealt by doc and
    detect and propose keep rows where they are, nothing is shuffled. A round's texts are kept once.
    """
    found = lambda d: detect(d.select("doc", "text")).groupBy("doc").agg((F.count_if(F.col("severity") == "P0") > 0).alias("_p0"))
    start = docs.select("doc", "text")
    open_ = start.join(found(start), "doc", "left").select("doc", "text", F.lit(0).cast("long").alias("applied"), F.lit(0).alias("rounds"), "_p0")
    done = []
    for k in range(rounds):
        plan = propose(open_.select("doc", "text")).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("id", "lo", "hi", "before", "replacement"))).alias("_p"))
        spans = F.when(~F.coalesce("_p0", F.lit(False)), F.col("_p"))
        rows = open_.join(plan, "doc", "left").select("doc", "text", "applied", "rounds", F.coalesce("text", F.lit("")).alias("_t"), spans.alias("_p"))
        rows = rows.select("*", repaired(F.col("_t"), F.col("_p")).alias("_d")).drop("_p")
        rows = rows.withColumn("reason", failed_gate(F.when(F.col("_d").isNull(), "no_patch"), F.col("_t"), F.col("_d.text"), default_gates))
        rows = rows.withColumn("committed", F.col("reason").isNull())
        new = F.when(F.col("committed"), F.col("_d.text")).otherwise(F.col("_t"))
        still = F.when(~F.col("committed") & (F.col("reason") != "no_patch"), "rolled_back").when(~F.col("committed") | (F.col("text") == new), "no_progress")
        after = reuse(rows.select("doc", new.alias("text"), (F.col("applied") + F.when(F.col("committed"), F.col("_d.n")).otherwise(0)).alias("applied"), (F.col("rounds") + 1).alias("rounds"), still.alias("_still")))
        state = after.join(reuse(found(after)), "doc", "left").withColumn("stop", F.when(F.col("_p0").isNull(), "resolved").otherwise(F.col("_still")))
        open_ = state.where("stop IS NULL").drop("stop", "_still")
        done.append(state.where("stop IS NOT NULL" if k + 1 < rounds else "true").select("doc", "text", "applied", "rounds", F.coalesce("stop", F.lit("max_rounds")).alias("stop")))
        if k + 1 == rounds or open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


def first_jobs(jobs: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """The first jobs in order, all without a limit; Spark takes them partition by partition."""
    rows = jobs.dropDuplicates(["path"]).orderBy(*order)
    return rows.limit(limit) if limit else rows


#: Tokens of a model call for a crop without known size, and pixels a token.
BASE_TOKENS, PIXELS_A_TOKEN = 258, 750


def candidate_summary(candidates: DataFrame) -> DataFrame:
    """Candidates by reason prefix, once a candidate, with crops of known size, their pixels (largest and all) and a linear bound of
    tokens. A candidate with several reasons counts in each, so the sum may exceed the total."""
    prefix = F.array_distinct(F.transform("reasons", lambda r: F.element_at(F.split(r, ":"), 1)))
    pixels = F.col("width") * F.col("height")
    rows = candidates.select(F.explode(prefix).alias("reason"), pixels.alias("pixels"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count("pixels").alias("sized"), F.coalesce(F.max("pixels"), F.lit(0)).alias("pixels_max"), F.coalesce(F.sum("pixels"), F.lit(0)).alias("pixels_total"),
                                      (F.count(F.lit(1)) * BASE_TOKENS + F.coalesce(F.sum(F.ceil(F.col("pixels") / PIXELS_A_TOKEN)), F.lit(0))).cast("long").alias("tokens"))


def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def formula_event_rows(spark, sf_dir):
    t = _turns(spark, sf_dir)
    k = F.length("text")
    blocks = t.select("conv_id", F.col("turn").alias("block_id"), F.when(F.col("turn") % 2 == 0, "display_formula").otherwise("text").alias("label"), F.col("text").alias("content"))
    candidates = t.select("conv_id", (F.col("turn") + F.when(k % 13 == 0, 1000).otherwise(0)).alias("block_id"), F.array(F.concat(F.lit("bare_op:"), (k % 3).cast("string")), F.lit("a")).alias("reasons"), F.when(k % 2 == 0, F.concat(F.lit("c"), F.col("turn").cast("string"))).otherwise("").alias("crop_path"), (k % 5 != 0).alias("fresh"), F.when(k % 7 == 0, "resolved").when(k % 7 == 1, "pending").alias("state"))
    renders = t.where("length(text) % 4 < 2").select("conv_id", F.array("turn", F.col("turn") + 1).alias("block_ids"), F.when(k % 3 == 0, "errors").otherwise("warnings").alias("level"), (k % 11 != 0).alias("fresh"))
    out = formula_events(candidates, renders, blocks, ["conv_id"])
    return out.select("conv_id", "block_id", "severity", F.array_join("reasons", ",").alias("reasons"), F.array_join("crops", ",").alias("crops"), "candidates", "errors", "warnings", "input_fingerprint")


def answer_corrections(spark, sf_dir):
    t = _turns(spark, sf_dir)
    k = F.length("text")
    ids = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    candidates = t.where("turn % 5 <> 4").select(ids.alias("candidate_id"), F.col("conv_id").alias("page"), F.col("turn").alias("block_id"), F.array(F.lit("a"), F.col("role")).alias("reasons"), F.when(k % 6 != 0, F.col("text")).alias("engine_latex"))
    answers = t.select(ids.alias("candidate_id"), F.when(k % 3 != 0, "correct").when(k % 2 == 0, "accept").otherwise("uncertain").alias("verdict"), F.concat(F.when(k % 4 == 0, "$$ ").when(k % 4 == 1, "$$ $").otherwise(" "), F.translate("text", "$\\", "§/"), F.when(k % 4 == 0, " $$").otherwise("")).alias("latex"), (k % 10 / 10).alias("confidence"), F.lit("p").alias("provider"), F.col("role").alias("model"), F.lit(1).alias("attempt"))
    out = to_corrections(answers, candidates)
    return out.select("candidate_id", "page", "block_id", "kind", F.sha2("corrected_latex", 256).alias("corrected"), "source", F.round("confidence", 6).alias("confidence"), "content_fingerprint", "status")


def decision_proposals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    findings = e.select(k.alias("finding_id"), (F.col("user_id") % 150).alias("doc"), (k % 50 - 1).alias("owner_start"), (k % 50 + k % 31).alias("owner_end"))
    decisions = e.select(k.alias("finding_id"), F.when(k % 4 == 0, "accept").otherwise("repair").alias("verdict"), (k % 50 + k % 5 - 2).alias("md_start"), (k % 50 + k % 7).alias("md_end"), F.col("event_type").alias("replacement"), F.lit("p").alias("provider"), F.lit("m").alias("model"), F.lit(0.9).alias("confidence"))
    return to_proposals(decisions, findings, docs).drop("confidence")


def decision_states(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    findings = e.select(k.alias("finding_id"), (k % 9).alias("page"), (k % 4).alias("block_id"), (k % 3 != 0).alias("source_grounded"))
    decisions = e.select(k.alias("finding_id"), F.when(k % 5 == 0, "accept").when(k % 5 == 1, "novel").when(k % 5 == 2, "unsure").otherwise("repair").alias("verdict"), (k % 18 % 10).alias("page"), (k % 8 % 5).alias("block_id"), F.col("event_type").alias("replacement"))
    made = block_repairs(decisions, findings).select("finding_id", F.lit(True).alias("_made"))
    capability = F.element_at(F.array(*map(F.lit, ["formulas", "assets", "source_audit", "else"])), (k % 4 + 1).cast("int"))
    rows = decisions.join(made, "finding_id", "left").withColumn("event_id", F.col("finding_id"))
    return rows.select("finding_id", decision_status(F.col("verdict"), F.coalesce("_made", F.lit(False))).alias("status"), route_of(capability).alias("route"))


def worklist_blocks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("page"), (F.col("event_id") % 12).alias("block_id"), F.col("event_type").alias("op"), "event_id")
    hits = e.where("event_id % 3 <> 0").select("page", "block_id", F.when(F.col("event_id") % 5 == 0, "frac_primed_denom").otherwise("bare_op").alias("kind"), "op")
    out = repair_worklist(hits, e.where("event_id % 7 = 0"), ["page"])
    return out.select("page", "block_id", F.array_join("kinds", ",").alias("kinds"), F.array_join("ops", ",").alias("ops"), "crop")


def note_checks(spark, sf_dir):
    """Notes on turns as pages: parts of the page's own text and of others', labels of blocks, pages with errors."""
    t = _turns(spark, sf_dir)
    k = F.length("text")
    pages = t.select("conv_id", "turn", F.col("text").alias("md"))
    d = lambda c: c.cast("double")
    notes = t.select("conv_id", "turn", (k % 5 + 1).cast("int").alias("category"), F.array(d(k % 40), d(k % 30), d(k % 40 + 10), d(k % 30 + 10)).alias("bbox"), F.when(k % 5 == 3, F.when(k % 2 == 0, "text").otherwise("table")).when(k % 7 == 0, "").when(k % 3 == 0, "no such note").otherwise(F.expr("substring(text, 5)")).alias("note"))
    block = lambda i, label, x0, x1: t.select("conv_id", "turn", F.lit(i).alias("source_index"), F.lit(label).alias("label"), F.lit(x0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(x1).alias("x1"), F.lit(30.0).alias("y1"))
    out = check_notes(notes, pages, t.where("turn % 3 = 1").select("conv_id", "turn"), block(0, "text", 0.0, 25.0).unionByName(block(1, "table", 20.0, 60.0)), ["conv_id", "turn"])
    return out.select("conv_id", "turn", "category", "ok")


def removal_checks(spark, sf_dir):
    """Notes on the words of documents; every seventh word was removed, some pages are figures, some documents lack some tokens."""
    rows = words(table(spark, sf_dir, "documents")).withColumn("removed", F.col("ix") % 7 == 0)
    k = F.col("ix")
    notes = rows.where("ix % 11 = 0").select("doc_id", (F.col("page") + F.when(k % 143 == 0, 100).otherwise(0)).alias("page"), k.alias("note_id"), F.when(k % 3 == 0, "wrong_del").when(k % 3 == 1, "missed_del").otherwise("other").alias("cat"), F.array(F.col("x0") + 12, F.col("y0"), F.col("x1"), F.col("y1")).alias("bbox"),
                                             F.when(k % 5 == 0, "wontfix").alias("resolution"), F.when(k % 13 == 0, "region").alias("kind"))
    kinds = rows.select("doc_id", "page").distinct().withColumn("kind", F.when((F.col("doc_id") + F.col("page")) % 6 == 0, "FIGURE").otherwise("SPEC_BODY"))
    tokens = rows.where("ix % 4 <> 0").select("doc_id", F.explode(F.regexp_extract_all(F.lower("word"), F.lit("[a-z0-9]+"), F.lit(0))).alias("token"))
    return check_removals(notes, rows, kinds, tokens, ["doc_id", "page"])


def model_reviews(spark, sf_dir):
    o = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.col("p_size").alias("s"), "p_name")
    root = o.select("item", F.col("item").alias("pos"), F.lit("formula").alias("class"), F.concat(F.lit("$ "), F.col("p_name"), F.lit(" $")).alias("latex"))
    models = spark.range(5).select(F.concat(F.lit("m"), "id").alias("model"), "id", (F.col("id") != 4).alias("valid"))
    answers = o.withColumn("id", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("model", F.concat(F.lit("m"), "id")).select("model", "item", F.col("item").alias("pos"), F.when((F.col("s") + F.col("id")) % 9 == 0, "mixed_text").otherwise("formula").alias("class"), F.when((F.col("s") * (F.col("id") + 1)) % 5 == 0, F.concat("p_name", F.lit("x"))).otherwise(F.col("p_name")).alias("latex"))
    out = model_review(answers, root, models)
    return out.select("item", "rank", "class", "is_root", F.array_join("supporters", ",").alias("supporters"), "disagreement")


def viewer_blocks(spark, sf_dir):
    t = _turns(spark, sf_dir)
    k = F.length("text")
    key = ["conv_id"]
    blocks = t.select("conv_id", F.col("turn").alias("block_id"), F.col("role").alias("label"), F.when(k % 5 != 0, F.array(*map(F.lit, [1.0, 2.0, 3.0, 4.0]))).otherwise(F.array(F.lit(1.0))).alias("bbox"), F.when(k % 3 != 0, F.col("turn")).alias("block_order"), F.col("text").alias("content"))
    audits = t.where("length(text) % 7 <> 0").select("conv_id", F.col("turn").alias("block_id"), F.lit("ocr").alias("content_source"), F.slice(F.split("text", " "), F.lit(1), (k % 6).cast("int")).alias("missing"), F.lit(None).cast("array<string>").alias("added"))
    fixes = t.where("turn % 2 = 0").select("conv_id", F.col("turn").alias("block_id"), F.lit("pending").alias("status"), F.lit("x").alias("corrected_latex"), F.when(k % 4 != 0, fingerprint(F.col("text"))).otherwise("stale").alias("content_fingerprint"))
    out = view_rows(blocks, audits, fixes, t.where("turn % 3 = 0").select("conv_id", F.col("turn").alias("block_id"), F.concat(F.lit("c"), F.col("turn").cast("string")).alias("candidate_id")), key)
    return out.select("conv_id", "block_id", F.col("bbox").isNotNull().alias("boxed"), "order", F.sha2("head", 256).alias("head"), "content_source", F.array_join("missing", " ").alias("missing"), "missing_truncated", "added_truncated", F.col("correction.status").alias("correction"), "candidate_id")


def limited_jobs(spark, sf_dir):
    """The first 25 jobs: the limit is the feature."""
    jobs = table(spark, sf_dir, "orders").select(F.concat(F.lit("/in/"), (F.col("o_orderkey") % 400).cast("string"), F.lit(".pdf")).alias("path"))
    return first_jobs(jobs, ["path"], 25)


def candidate_sums(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.array(F.concat(F.lit("bare_op:"), "l_returnflag"), F.when(F.col("l_linenumber") % 2 == 0, "bare_op:x").otherwise("render"), F.lower("l_linestatus")).alias("reasons"), F.when(F.col("l_partkey") % 5 != 0, (F.col("l_quantity") * 10).cast("long")).alias("width"), (F.col("l_suppkey") % 90 + 10).alias("height"))
    return candidate_summary(li)


def repaired_documents(spark, sf_dir):
    """Whole texts with padded math, without math, and with a lone dollar at the end, repaired until nothing changes."""
    text = F.translate("text", "$\\", "§/")
    marked = F.when(F.col("doc_id") % 3 == 0, F.replace(text, F.lit("e "), F.lit("e $ q$ "))).when(F.col("doc_id") % 3 == 1, text).otherwise(F.concat(F.replace(text, F.lit("s "), F.lit("s $x $ ")), F.lit(" $a")))
    docs = by_document(table(spark, sf_dir, "documents").select("doc_id", "text")).select(F.col("doc_id").alias("doc"), marked.alias("text"))
    severity = folds.text_udf(lambda t: [x[1] for x in folds.delimiter_events(t)], "array<string>")
    spans = folds.text_udf(lambda t: [{"id": i, "lo": a, "hi": b, "before": hashlib.sha256(t[a:b].encode()).hexdigest(), "replacement": c} for i, (a, b, c) in enumerate(folds.whitespace_proposals(t))], "array<struct<id: long, lo: long, hi: long, before: string, replacement: string>>")
    out = repair_loop(docs, lambda d: d.select("doc", F.explode(severity(F.col("text"))).alias("severity")), lambda d: d.select("doc", F.inline(spans(F.col("text")))), 3)
    return out.select("doc", "applied", "rounds", "stop", F.sha2("text", 256).alias("digest"))


QUERIES = {f.__name__: f for f in (formula_event_rows, answer_corrections, decision_proposals, decision_states, worklist_blocks, note_checks, removal_checks, model_reviews, viewer_blocks, limited_jobs, candidate_sums, repaired_documents)}

ORACLE = {
    "formula_event_rows": """WITH t AS (SELECT *, length(text) AS k FROM conversations),
 c AS (SELECT conv_id, turn AS b, ['bare_op:' || k % 3, 'a'] AS rs, CASE WHEN k % 2 = 0 THEN 'c' || turn END AS crop FROM t WHERE k % 13 <> 0 AND k % 5 <> 0 AND k % 7 <> 0),
 r AS (SELECT conv_id, unnest([turn, turn + 1]) AS b, CASE WHEN k % 3 = 0 THEN 'errors' ELSE 'warnings' END AS level FROM t WHERE k % 4 < 2 AND k % 11 <> 0),
 u AS (SELECT conv_id, b, rs, crop, 'candidate' AS level FROM c UNION ALL SELECT conv_id, b, [], NULL, level FROM r),
 g AS (SELECT conv_id, b, array_to_string(list_sort(list_distinct(flatten(list(rs)))), ',') AS reasons, coalesce(string_agg(DISTINCT crop, ',' ORDER BY crop), '') AS crops, count(*) FILTER (level = 'candidate') AS candidates, count(*) FILTER (level = 'errors') AS errors, count(*) FILTER (level = 'warnings') AS warnings FROM u GROUP BY ALL)
 SELECT g.conv_id, b AS block_id, CASE WHEN errors > 0 THEN 'P1' ELSE 'P2' END AS severity, reasons, crops, candidates, errors, warnings, sha256('{"block_id":' || b || ',"content":' || to_json(text) || ',"label":"' || CASE WHEN turn % 2 = 0 THEN 'display_formula' ELSE 'text' END || '"}') AS input_fingerprint FROM g JOIN t ON t.conv_id = g.conv_id AND t.turn = b""",
    "answer_corrections": r"""WITH t AS (SELECT *, length(text) AS k, trim(translate(text, '$\', '§/'), ' ') AS x FROM conversations WHERE turn % 5 <> 4)
 SELECT conv_id || '-' || turn AS candidate_id, conv_id AS page, turn AS block_id, 'a+' || role AS kind, sha256('$$ ' || x || ' $$') AS corrected, 'agent:p:' || role AS source, round(k % 10 / 10, 6) AS confidence, substr(sha256(CASE WHEN k % 6 <> 0 THEN text ELSE '' END), 1, 16) AS content_fingerprint, 'accepted' AS status FROM t WHERE k % 3 <> 0""",
    "decision_proposals": """WITH e AS (SELECT event_id AS id, user_id % 150 AS doc, event_id % 50 - 1 AS a, event_id % 50 + event_id % 31 AS b, event_id % 50 + event_id % 5 - 2 AS lo, event_id % 50 + event_id % 7 AS hi, event_type FROM events WHERE event_id % 4 <> 0)
 SELECT doc, id AS finding_id, lo AS md_start, hi AS md_end, sha256(substr(text, lo + 1, hi - lo)) AS before_fingerprint, event_type AS replacement, 'agent:p:m' AS producer FROM e JOIN documents ON doc_id = doc WHERE a >= 0 AND a <= lo AND lo <= hi AND hi <= b AND b <= length(text)""",
    "decision_states": """SELECT event_id AS finding_id, CASE WHEN k5 = 0 THEN 'ignored' WHEN k5 = 1 THEN 'novel_confirmed' WHEN k5 = 2 THEN 'uncertain' WHEN event_id % 3 <> 0 AND event_id % 9 > 0 AND event_id % 9 = event_id % 18 % 10 AND event_id % 4 = event_id % 8 % 5 THEN 'accepted' ELSE 'repair_unapplied' END AS status,
  (['formula_agent', 'blocker:assets', 'quality_agent:block', 'blocker:else'])[event_id % 4 + 1] AS route FROM (SELECT *, event_id % 5 AS k5 FROM events)""",
    "worklist_blocks": """WITH e AS (SELECT user_id % 40 AS page, event_id % 12 AS block_id, event_type, event_id FROM events),
 h AS (SELECT page, block_id, CASE WHEN event_id % 5 = 0 THEN 'frac_primed_denom' ELSE 'bare_op' END AS kind, event_type AS op FROM e WHERE event_id % 3 <> 0 UNION ALL SELECT page, block_id, 'render_error', NULL FROM e WHERE event_id % 7 = 0)
 SELECT page, block_id, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, coalesce(string_agg(DISTINCT op, ',' ORDER BY op), '') AS ops, printf('page_%04d_block_%d.png', page, block_id) AS crop FROM h GROUP BY page, block_id""",
    "note_checks": """WITH t AS (SELECT *, length(text) AS k FROM conversations),
 n AS (SELECT *, CAST(k % 5 + 1 AS INTEGER) AS category, trim(CASE WHEN k % 5 = 3 THEN CASE WHEN k % 2 = 0 THEN 'text' ELSE 'table' END WHEN k % 7 = 0 THEN '' WHEN k % 3 = 0 THEN 'no such note' ELSE substr(text, 5) END, ' ') AS note, k % 40 + 5 AS x, k % 30 + 5 AS y FROM t)
 SELECT conv_id, turn, category, CASE category WHEN 1 THEN turn % 3 <> 1 WHEN 3 THEN note <> '' AND contains(text, note) WHEN 4 THEN note <> '' AND coalesce(CASE WHEN y > 30 THEN NULL WHEN x <= 25 THEN 'text' ELSE 'table' END = note, false) END AS ok FROM n""",
    "removal_checks": "WITH " + WORDS + """, r AS (SELECT *, ix % 7 = 0 AS removed FROM words), n AS (SELECT doc_id, page + CASE WHEN ix % 143 = 0 THEN 100 ELSE 0 END AS page, ix AS id, x0 + 12 AS a, y0 AS b, x1 AS c, y1 AS d FROM r WHERE ix % 11 = 0),
 tk AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(word), '[a-z0-9]+')) AS token FROM r WHERE ix % 4 <> 0), pg AS (SELECT DISTINCT doc_id, page FROM r),
 h AS (SELECT n.doc_id, n.page, id, arg_min(word, r.ix) AS w FROM n JOIN r ON r.doc_id = n.doc_id AND r.page = n.page AND (x0 + x1) / 2 BETWEEN a - 1 AND c + 1 AND (y0 + y1) / 2 BETWEEN b - 1 AND d + 1 AND removed = (id % 3 = 1) GROUP BY ALL),
 l AS (SELECT h.doc_id, h.page, id, bool_and(tk.token IS NOT NULL) AS found FROM (SELECT *, unnest(regexp_extract_all(lower(w), '[a-z0-9]+')) AS token FROM h) h LEFT JOIN tk ON tk.doc_id = h.doc_id AND tk.token = h.token GROUP BY ALL)
 SELECT n.doc_id, CAST(n.page AS INTEGER) AS page, CAST(n.id AS INTEGER) AS note_id, CASE WHEN n.id % 5 = 0 THEN 'skipped' WHEN n.id % 3 = 2 OR n.id % 13 = 0 THEN 'manual' WHEN pg.page IS NULL OR (n.doc_id + n.page) % 6 = 0 THEN 'failed' WHEN w IS NOT NULL AND (n.id % 3 = 1 OR coalesce(found, true)) THEN 'passed' ELSE 'failed' END AS verdict
 FROM n LEFT JOIN pg USING (doc_id, page) LEFT JOIN h ON h.doc_id = n.doc_id AND h.page = n.page AND h.id = n.id LEFT JOIN l ON l.doc_id = n.doc_id AND l.page = n.page AND l.id = n.id""",
    "model_reviews": """WITH m AS (SELECT unnest(range(4)) AS id), a AS (SELECT p_partkey AS item, 'm' || id AS model, CASE WHEN (p_size + id) % 9 = 0 THEN 'mixed_text' ELSE 'formula' END AS class, regexp_replace(CASE WHEN (p_size * (id + 1)) % 5 = 0 THEN p_name || 'x' ELSE p_name END, '\\s+', '', 'g') AS f, regexp_replace(p_name, '\\s+', '', 'g') AS r FROM part, m),
 g AS (SELECT item, class, f, class = 'formula' AND f = r AS is_root, count(*) AS c, string_agg(model, ',' ORDER BY model) AS supporters FROM a GROUP BY item, class, f, r)
 SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY is_root DESC, c DESC, f, class) AS INTEGER) AS rank, class, is_root, supporters, count(*) OVER (PARTITION BY item) <> 1 OR NOT is_root AS disagreement FROM g""",
    "viewer_blocks": """WITH t AS (SELECT *, length(text) AS k FROM conversations)
 SELECT conv_id, turn AS block_id, k % 5 <> 0 AS boxed, CASE WHEN k % 3 <> 0 THEN turn END AS "order", sha256(substr(text, 1, 120)) AS head, CASE WHEN k % 7 <> 0 THEN 'ocr' END AS content_source, CASE WHEN k % 7 <> 0 THEN array_to_string(list_slice(string_split(text, ' '), 1, least(k % 6, 3)), ' ') ELSE '' END AS missing,
  k % 7 <> 0 AND least(k % 6, len(string_split(text, ' '))) > 3 AS missing_truncated, false AS added_truncated, CASE WHEN turn % 2 = 0 AND k % 4 <> 0 THEN 'pending' END AS correction, CASE WHEN turn % 3 = 0 THEN 'c' || turn END AS candidate_id FROM t""",
    "repaired_documents": r"""WITH d AS (SELECT doc_id, translate(text, '$\', '§/') AS t FROM documents), c AS (SELECT doc_id, t, (length(t) - length(replace(t, CASE WHEN doc_id % 3 = 0 THEN 'e ' ELSE 's ' END, ''))) // 2 AS n FROM d)
 SELECT doc_id AS doc, CASE WHEN doc_id % 3 = 1 THEN 0 ELSE n END AS applied, CASE WHEN doc_id % 3 = 2 AND n > 0 THEN 2 ELSE 1 END AS rounds, CASE WHEN doc_id % 3 = 2 THEN 'no_progress' ELSE 'resolved' END AS stop,
  sha256(CASE doc_id % 3 WHEN 0 THEN replace(t, 'e ', 'e $q$ ') WHEN 1 THEN t ELSE replace(t, 's ', 's $x$ ') || ' $a' END) AS digest FROM c""",
    "limited_jobs": "SELECT DISTINCT '/in/' || o_orderkey % 400 || '.pdf' AS path FROM orders ORDER BY path LIMIT 25",
    "candidate_sums": """WITH l AS (SELECT row_number() OVER () AS i, l_returnflag, l_linenumber, lower(l_linestatus) AS s, CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_quantity * 10 AS BIGINT) END * (l_suppkey % 90 + 10) AS px FROM lineitem),
 r AS (SELECT i, px, 'bare_op' AS reason FROM l UNION SELECT i, px, CASE WHEN l_linenumber % 2 = 0 THEN 'bare_op' ELSE 'render' END FROM l UNION SELECT i, px, s FROM l)
 SELECT reason, count(*) AS n, count(px) AS sized, coalesce(max(px), 0) AS pixels_max, CAST(coalesce(sum(px), 0) AS BIGINT) AS pixels_total, CAST(count(*) * 258 + coalesce(sum(ceil(px / 750)), 0) AS BIGINT) AS tokens FROM r GROUP BY reason""",
}
