"""Joins, roll-ups, contracts and transactions of the repair loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.sources.tables import DAMAGED, damaged, table

#: Fixed value: correction states.
STATUSES = ("pending", "accepted", "rejected")


def fingerprint(text: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, length)


def event_id(*identity: Column) -> Column:
    """An id over identity fields only, so that message and status may change."""
    return F.substring(F.sha2(F.to_json(F.struct(*identity)), 256), 1, 20)


def apply_corrections(blocks: DataFrame, corrections: DataFrame, keys: list[str]) -> DataFrame:
    """Replaces content where the last accepted correction has the fingerprint of the present content; pending and rejected rows
    play no part."""
    last = corrections.where("status = 'accepted'").withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("seq")))).where("_r = 1").select(*keys, "corrected", "stored")
    rows = blocks.join(last, keys, "left")
    hit = F.coalesce(F.col("stored") == fingerprint(F.col("content")), F.lit(False))
    return rows.select(*keys, F.when(hit, F.col("corrected")).otherwise(F.col("content")).alias("content"), hit.alias("applied"))


def apply_decisions(blocks: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-block replacement by adopted text; applying it again changes nothing."""
    rows = blocks.join(decisions.select(*keys, F.col("text").alias("_t")), keys, "left")
    return rows.withColumn("content", F.coalesce("_t", "content")).drop("_t")


def set_status(corrections: DataFrame, keys: dict[str, object], status: str) -> tuple[DataFrame, bool]:
    """UPDATE of one correction's status, and whether any row matched; an unknown status is an error."""
    if status not in STATUSES:
        raise ValueError(f"unknown status {status}")
    match = F.lit(True)
    for k, v in keys.items():
        match = match & F.col(k).eqNullSafe(F.lit(v))
    return corrections.withColumn("status", F.when(match, F.lit(status)).otherwise(F.col("status"))), not corrections.where(match).isEmpty()


def changed_keys(before: DataFrame, after: DataFrame, identity: list[str], key: str) -> DataFrame:
    """Keys of rows that are on one side only."""
    return before.select(*identity).exceptAll(after.select(*identity)).unionByName(after.select(*identity).exceptAll(before.select(*identity))).select(key).distinct()


def carry_terminal(current: DataFrame, prior: DataFrame, key: str, terminal: tuple[str, ...]) -> DataFrame:
    done = prior.where(F.col("status").isin(*terminal)).select(key, F.col("status").alias("_s"))
    return current.join(done, key, "left").withColumn("status", F.coalesce("_s", "status")).drop("_s")


def reuse_or_recompute(pages: DataFrame, prior: DataFrame, keys: list[str]) -> DataFrame:
    """A page's report is reused iff the fingerprint of all its inputs is unchanged."""
    old = prior.select(*keys, F.col("fp").alias("_fp"))
    return pages.join(old, keys, "left").withColumn("reused", F.coalesce(F.col("fp") == F.col("_fp"), F.lit(False))).drop("_fp")


def resolve_owner(refs: DataFrame, fragments: DataFrame, page: list[str]) -> DataFrame:
    """The one span a block resolves to, or blocker:unlocatable_md_owner. Asked blocks and spans meet in one aggregate of fixed size a
    block: there is one span where the least and the greatest are the same."""
    spans = fragments.select(*page, F.explode("block_ids").alias("block_id"), F.col("span_start").alias("a"), F.when(F.col("span_start").isNotNull(), F.col("span_end")).alias("b"), F.lit(0).alias("asked"))
    both = spans.unionByName(refs.select(*page, "block_id", F.lit(1).alias("asked")), allowMissingColumns=True)
    sums = both.groupBy(*page, "block_id").agg(F.max("asked").alias("asked"), F.min("a").alias("a"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b"), F.count("a").alias("n"), F.count("b").alias("m"))
    one = F.coalesce((F.col("a") == F.col("a1")) & F.when(F.col("m") > 0, (F.col("n") == F.col("m")) & (F.col("b0") == F.col("b"))).otherwise(True), F.lit(False))
    return sums.where("asked = 1").select(*page, "block_id", F.when(one, F.col("a")).alias("span_start"), F.when(one, F.col("b")).alias("span_end"), F.when(one, "ok").otherwise("blocker:unlocatable_md_owner").alias("route"))


def merge_candidates(hits: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Upsert: first non-empty field wins, reasons are added in order of arrival, once each."""
    first = F.min_by(F.col("field"), F.when(F.coalesce(F.col("field"), F.lit("")) != "", F.col(order)))
    reasons = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, "reason"))), lambda s: s["reason"]))
    return hits.groupBy(*keys).agg(F.max(F.when(F.coalesce(F.col("field"), F.lit("")) != "", True)).alias("_any"), first.alias("_f"), F.array_join(reasons, "|").alias("reasons"), F.max(F.col("is_error").cast("int")).alias("_e")).select(*keys, F.when(F.col("_any"), F.col("_f")).alias("field"), "reasons", F.when(F.col("_e") == 1, "P1").otherwise("P2").alias("severity"))


def group_answers(answers: DataFrame, key: str, root: str) -> DataFrame:
    """Answers grouped by normalised text, root's group first, then by size, then text; disagreement is more than one group."""
    g = answers.groupBy(key, "answer").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("answer") == F.col(root)).alias("is_root"), F.array_join(F.array_sort(F.collect_set("model")), ",").alias("supporters"))
    w = Window.partitionBy(key).orderBy(F.desc("is_root"), F.desc("n"), "answer")
    return g.withColumn("rank", F.row_number().over(w)).withColumn("disagreement", F.count(F.lit(1)).over(Window.partitionBy(key)) > 1)


#: Verdicts, and those that carry a formula.
VERDICTS = ("accept", "correct", "uncertain", "not_formula_error")


def batch_contract(returned: DataFrame, expected: DataFrame, batch: str) -> DataFrame:
    """Whether a batch's answers (pos, id, verdict, latex, confidence) hold: ids are those expected, each once and in order; verdicts
    are known; a correction has a formula, and no formula has control characters; confidence is from 0 to 1. The first
    fault rejects the whole batch."""
    ids = lambda df, name: df.groupBy(batch).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda s: s["id"]).alias(name))
    latex = F.coalesce("latex", F.lit(""))
    bad = returned.groupBy(batch).agg(
        F.bool_or(~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))).alias("_verdict"), F.bool_or((F.col("verdict") == "correct") & (F.trim(latex) == "")).alias("_empty"),
        F.bool_or(latex.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")).alias("_control"), F.bool_or(~F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(False))).alias("_confidence"))
    rows = ids(expected, "want").join(ids(returned, "got"), batch, "left").join(bad, batch, "left")
    got = F.coalesce("got", F.array().cast(rows.schema["want"].dataType))
    reason = F.when(F.size(F.array_distinct(got)) < F.size(got), "duplicate_id").when((F.size(F.array_except("want", got)) > 0) | (F.size(F.array_except(got, "want")) > 0), "id_set_differs").when(got != F.col("want"), "order_differs") \
        .when(F.col("_verdict"), "unknown_verdict").when(F.col("_empty"), "empty_correction").when(F.col("_control"), "control_characters").when(F.col("_confidence"), "confidence_out_of_range")
    return rows.select(batch, reason.alias("reason"), reason.isNull().alias("accepted"))


def cluster_packages(df: DataFrame, family: str, key: str, severity: str, size: int = 8) -> DataFrame:
    """Packages grouped by slug, in chunks, with an id over their members."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(family), "[^a-z0-9]+", "-"), "^-|-$", "")
    rows = df.withColumn("slug", slug).withColumn("_r", F.row_number().over(Window.partitionBy("slug").orderBy(key)) - 1).withColumn("chunk", F.expr(f"_r div {size}"))
    members = F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string")), "|")
    out = rows.groupBy("slug", "chunk").agg(F.count(F.lit(1)).alias("n"), members.alias("_m"), F.array_join(F.array_sort(F.collect_set(severity)), ",").alias("severities"))
    return out.select("slug", "chunk", "n", "severities", F.concat("slug", F.lit("-"), F.substring(F.sha2("_m", 256), 1, 10)).alias("cluster_id"))


def default_gates(before: Column, after: Column) -> dict[str, Column]:
    """Gates of a patched text: it is not blank, and neither lines with an odd number of dollars, nor local images without a file
    name, nor known incompatible commands become more (each relative to the text before)."""
    odd = lambda t: F.size(F.filter(F.split(t, "\n"), lambda x: F.regexp_count(x, F.lit(r"(?<!\\)(?<!\$)\$(?!\$)")) % 2 == 1))
    hollow = lambda t: F.regexp_count(t, F.lit(r"!\[[^\]]*\]\(\s*\)"))
    commands = lambda t: F.regexp_count(t, F.lit(r"\\(?:upmu|ensuremath)(?![a-zA-Z])"))
    return {"nonempty": F.length(F.trim(after)) > 0, "delimiters": odd(after) <= odd(before), "assets": hollow(after) <= hollow(before), "commands": commands(after) <= commands(before)}


def failed_gate(reason: Column, before: Column, after: Column, gates) -> Column:
    """The reason, else the first gate that fails."""
    for name, holds in gates(before, after).items():
        reason = reason.when(~holds, name)
    return reason


def apply_patches(docs: DataFrame, patches: DataFrame, key: str, gates=default_gates) -> DataFrame:
    """Text with non-overlapping [lo, hi) replacements, applied only if the baseline's hash holds and every gate passes: key, text,
    committed, reason (stale_baseline, or the first gate that fails).

    Offsets are fixed on the baseline, so kept and replaced segments are cut independently and joined once.
    """
    packed = patches.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "replacement"))).alias("_p"), F.min("baseline_hash").alias("_h"))
    rows = docs.join(packed, key, "left").withColumn("_t", F.coalesce("text", F.lit("")))
    done = F.aggregate("_p", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda s, p: F.struct(p["hi"].cast("int").alias("at"), F.concat(s["out"], F.substring(F.col("_t"), s["at"] + 1, p["lo"].cast("int") - s["at"]), p["replacement"]).alias("out")))
    rows = rows.withColumn("_d", F.when(F.col("_h") == F.sha2("_t", 256), done))
    rows = rows.withColumn("_a", F.concat("_d.out", F.substring(F.col("_t"), F.col("_d.at") + 1, F.length("_t"))))
    reason = F.when(F.col("_h").isNull(), "no_patch").when(F.col("_a").isNull(), "stale_baseline")
    rows = rows.withColumn("reason", failed_gate(reason, F.col("_t"), F.col("_a"), gates))
    return rows.select(key, F.when(F.col("reason").isNull(), F.col("_a")).otherwise(F.col("_t")).alias("text"), F.col("reason").isNull().alias("committed"), "reason")


def count_reasons(df: DataFrame, reasons: str) -> DataFrame:
    """Candidates by reason prefix, each counted once a prefix."""
    prefix = F.array_distinct(F.transform(F.split(reasons, r"\|"), lambda x: F.element_at(F.split(x, ":"), 1)))
    return df.select(F.explode(prefix).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def ordered_markdown(df: DataFrame, key: str, page: str, order: str, text: str) -> DataFrame:
    """Documents from blocks by page and order, blank ones skipped, blank lines between, a newline at the end."""
    rows = df.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "")
    parts = F.transform(F.array_sort(F.collect_list(F.struct(page, order, text))), lambda s: s[text])
    return rows.groupBy(key).agg(F.concat(F.array_join(parts, "\n\n"), F.lit("\n")).alias("markdown"))


def fuse_formulas(df: DataFrame, page: list[str]) -> DataFrame:
    """A formula followed by its number becomes one tagged fragment; the number is absorbed, empty rows are skipped."""
    w = Window.partitionBy(*page).orderBy("pos")
    rows = df.withColumn("_nl", F.lead("label").over(w)).withColumn("_nc", F.lead("content").over(w)).withColumn("_pl", F.lag("label").over(w)).withColumn("_pc", F.lag("content").over(w))
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    absorbed = (F.col("label") == "formula_number") & (F.col("_pl") == "display_formula") & ~blank(F.col("_pc"))
    title = F.max(F.when(F.col("label") == "paragraph_title", 1).otherwise(0)).over(Window.partitionBy(*page)) == 1
    md = F.when((F.col("label") == "display_formula") & (F.col("_nl") == "formula_number"), F.concat(F.lit("$$ "), "content", F.lit(" \\tag{"), F.coalesce("_nc", F.lit("")), F.lit("} $$"))) \
        .when(F.col("label") == "display_formula", F.concat(F.lit("$$ "), "content", F.lit(" $$"))) \
        .when((F.col("label") == "paragraph_title") | ((F.col("label") == "doc_title") & title), F.concat(F.lit("## "), "content")).otherwise(F.col("content"))
    return rows.withColumn("md", md).where(~F.coalesce(absorbed, F.lit(False)) & ~blank(F.col("content"))).select(*page, "pos", "md")


def _blocks(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("content"))


def corrections_applied(spark, sf_dir):
    """Two corrections a block, with every pair of states, and some stale fingerprints."""
    blocks = _blocks(spark, sf_dir)
    state = lambda k: F.element_at(F.array(*map(F.lit, STATUSES)), (k % 3 + 1).cast("int"))
    fix = lambda seq, mark, k, stale: blocks.select("conv_id", "turn", F.lit(seq).alias("seq"), F.concat(F.lit(mark), "content").alias("corrected"), F.when(stale, "stale").otherwise(fingerprint(F.col("content"))).alias("stored"), state(k).alias("status"))
    fixes = fix(1, "#", F.col("turn"), F.col("conv_id") % 4 == 0).unionByName(fix(2, "##", F.col("conv_id") + F.floor(F.col("turn") / 3), F.col("conv_id") % 5 == 0))
    return apply_corrections(blocks, fixes, ["conv_id", "turn"]).select("conv_id", "turn", "applied", F.sha2("content", 256).alias("digest"))


def decisions_applied(spark, sf_dir):
    blocks = _blocks(spark, sf_dir)
    chosen = blocks.select("conv_id", "turn", F.when(F.col("turn") % 3 != 0, F.concat(F.lit("> "), "content")).alias("text")).where("conv_id % 4 <> 1")
    once = apply_decisions(blocks, chosen, ["conv_id", "turn"])
    return apply_decisions(once, chosen, ["conv_id", "turn"]).select("conv_id", "turn", F.sha2("content", 256).alias("digest"))


def carried_states(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    now = e.select("event_id", F.lit("open").alias("status"))
    prior = e.where("event_id % 3 <> 0").select("event_id", F.when(F.col("event_id") % 2 == 0, "resolved").otherwise("open").alias("status"))
    return carry_terminal(now, prior, "event_id", ("resolved", "rejected"))


def reason_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("bare_op:"), "o_orderstatus", F.lit("|"), F.when(F.col("o_orderkey") % 2 == 0, "bare_op:x").otherwise("render"), F.lit("|"), F.substring("o_orderpriority", 1, 1), F.lit(":p")).alias("reasons"))
    return count_reasons(rows, "reasons")


def stale_reuse(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    now = docs.select("doc_id", F.sha2(damaged(F.col("text"), F.col("doc_id")), 256).alias("fp"))
    return reuse_or_recompute(now, docs.select("doc_id", F.sha2("text", 256).alias("fp")), ["doc_id"])


def changed_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return changed_keys(docs.select("doc_id", F.sha2("text", 256).alias("h")), docs.select("doc_id", F.sha2(damaged(F.col("text"), F.col("doc_id")), 256).alias("h")), ["doc_id", "h"], "doc_id")


def merged_candidates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("").alias("field"), F.col("event_type").alias("reason"), (F.col("event_id") % 50 == 0).alias("is_error"))
    return merge_candidates(e, ["user_id"], "event_id")


def answer_groups(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("item"), F.col("event_type").alias("answer"), (F.col("event_id") % 7).cast("string").alias("model"), F.lit("click").alias("root"))
    return group_answers(e, "item", "root")


def batch_contracts(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("batch"), k.alias("id"), k.alias("pos"), F.when(k % 37 == 0, "maybe").when(k % 4 == 0, "correct").otherwise("accept").alias("verdict"),
        F.when(k % 53 == 0, " ").when(k % 59 == 0, "a\u0007b").otherwise("x^2").alias("latex"), F.when(k % 61 == 0, 1.5).otherwise(0.9).alias("confidence"))
    got = o.where("batch % 5 <> 1 OR id % 3 <> 0").withColumn("pos", F.when(F.col("batch") % 5 == 2, -F.col("pos")).otherwise(F.col("pos")))
    return batch_contract(got.unionByName(o.where("batch % 5 = 3")), o, "batch")


def package_clusters(spark, sf_dir):
    return cluster_packages(table(spark, sf_dir, "part").select("p_type", "p_partkey", "p_brand"), "p_type", "p_partkey", "p_brand")


def patched_documents(spark, sf_dir):
    """Patches of whole texts: one that replaces, one that inserts, one that deletes; some on a stale baseline, some that break a gate."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = docs.select("doc_id", F.when(F.col("doc_id") % 9 == 0, "stale").otherwise(F.sha2("text", 256)).alias("baseline_hash"))
    first = F.when(F.col("doc_id") % 7 == 1, "$").when(F.col("doc_id") % 7 == 2, "![x]()").when(F.col("doc_id") % 7 == 3, "\\upmu ").otherwise("<a>")
    patch = lambda lo, hi, t: base.select("doc_id", F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), t.alias("replacement"), "baseline_hash")
    out = apply_patches(docs, patch(0, 3, first).unionByName(patch(5, 5, F.lit("<b>"))).unionByName(patch(7, 9, F.lit(""))).where("doc_id % 10 <> 0"), "doc_id")
    return out.select("doc_id", "committed", "reason", F.sha2("text", 256).alias("digest"))


def owner_spans(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    frags = li.select(F.col("l_orderkey").alias("page"), F.array((F.col("l_linenumber") % 4).cast("int")).alias("block_ids"), (F.col("l_linenumber") * 10).alias("span_start"), (F.col("l_linenumber") * 10 + 8).alias("span_end"))
    refs = li.select(F.col("l_orderkey").alias("page"), F.expr("cast(l_linenumber % 5 as int)").alias("block_id")).distinct()
    return resolve_owner(refs, frags, ["page"])


def conversation_markdown(spark, sf_dir):
    return ordered_markdown(_blocks(spark, sf_dir).withColumn("page", F.expr("turn div 3")), "conv_id", "page", "turn", "content").select("conv_id", F.sha2("markdown", 256).alias("digest"))


def fused_formulas(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, ["display_formula", "formula_number", "text", "doc_title", "paragraph_title"])), (F.col("turn") * 3 % 5 + 1).cast("int"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), label.alias("label"), F.when(F.col("turn") % 6 != 5, F.concat(F.lit("b"), F.col("turn").cast("string"))).otherwise("").alias("content"))
    return fuse_formulas(rows, ["conv_id"])


def event_ids(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("u"), F.col("event_type").alias("t"))
    return e.distinct().select("u", "t", event_id(F.col("t"), F.col("u")).alias("id"))


QUERIES = {f.__name__: f for f in (corrections_applied, decisions_applied, carried_states, reason_counts, stale_reuse, changed_documents, merged_candidates, answer_groups, batch_contracts, package_clusters, patched_documents, owner_spans, conversation_markdown, fused_formulas, event_ids)}

ORACLE = {
    "corrections_applied": """WITH b AS (SELECT conv_id, turn, text, turn % 3 = 1 AS a1, (conv_id + turn // 3) % 3 = 1 AS a2 FROM conversations),
 c AS (SELECT *, CASE WHEN a2 THEN CASE WHEN conv_id % 5 <> 0 THEN '##' END WHEN a1 AND conv_id % 4 <> 0 THEN '#' END AS mark FROM b)
 SELECT conv_id, turn, mark IS NOT NULL AS applied, sha256(coalesce(mark, '') || text) AS digest FROM c""",
    "decisions_applied": "SELECT conv_id, turn, sha256(CASE WHEN conv_id % 4 <> 1 AND turn % 3 <> 0 THEN '> ' || text ELSE text END) AS digest FROM conversations",
    "carried_states": "SELECT event_id, CASE WHEN event_id % 3 <> 0 AND event_id % 2 = 0 THEN 'resolved' ELSE 'open' END AS status FROM events",
    "reason_counts": """WITH r AS (SELECT o_orderkey, 'bare_op' AS reason FROM orders UNION SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'bare_op' ELSE 'render' END FROM orders UNION SELECT o_orderkey, substr(o_orderpriority, 1, 1) FROM orders)
 SELECT reason, count(*) AS n FROM r GROUP BY reason""",
    "stale_reuse": f"SELECT doc_id, sha256({DAMAGED}) AS fp, sha256({DAMAGED}) = sha256(text) AS reused FROM documents",
    "changed_documents": f"SELECT DISTINCT doc_id FROM documents WHERE {DAMAGED} <> text",
    "merged_candidates": """WITH f AS (SELECT user_id, event_type, min(event_id) AS e FROM events GROUP BY ALL)
 SELECT e.user_id, arg_min(event_type, event_id) FILTER (event_id % 3 = 0) AS field, (SELECT string_agg(event_type, '|' ORDER BY f.e) FROM f WHERE f.user_id = e.user_id) AS reasons, CASE WHEN bool_or(event_id % 50 = 0) THEN 'P1' ELSE 'P2' END AS severity FROM events e GROUP BY e.user_id""",
    "answer_groups": """WITH g AS (SELECT user_id % 40 AS item, event_type AS answer, count(*) AS n, event_type = 'click' AS is_root, array_to_string(list_sort(list(DISTINCT CAST(event_id % 7 AS VARCHAR))), ',') AS supporters FROM events GROUP BY ALL)
 SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY is_root DESC, n DESC, answer) AS INTEGER) AS rank, count(*) OVER (PARTITION BY item) > 1 AS disagreement FROM g""",
    "batch_contracts": """WITH g AS (SELECT o_custkey AS batch, count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) AS thirds, bool_or(k % 37 = 0) AS v, bool_or(k % 37 <> 0 AND k % 4 = 0 AND k % 53 = 0) AS e, bool_or(k % 53 <> 0 AND k % 59 = 0) AS c, bool_or(k % 61 = 0) AS f
   FROM (SELECT *, o_orderkey AS k FROM orders) GROUP BY 1),
 r AS (SELECT batch, CASE WHEN batch % 5 = 3 THEN 'duplicate_id' WHEN batch % 5 = 1 AND thirds > 0 THEN 'id_set_differs' WHEN batch % 5 = 2 AND n > 1 THEN 'order_differs'
   WHEN v THEN 'unknown_verdict' WHEN e THEN 'empty_correction' WHEN c THEN 'control_characters' WHEN f THEN 'confidence_out_of_range' END AS reason FROM g) SELECT batch, reason, reason IS NULL AS accepted FROM r""",
    "package_clusters": """WITH s AS (SELECT *, regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM part), r AS (SELECT *, (row_number() OVER (PARTITION BY slug ORDER BY p_partkey) - 1) // 8 AS chunk FROM s)
 SELECT slug, chunk, count(*) AS n, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS severities, slug || '-' || substr(sha256(string_agg(CAST(p_partkey AS VARCHAR), '|' ORDER BY p_partkey)), 1, 10) AS cluster_id FROM r GROUP BY slug, chunk""",
    "patched_documents": r"""WITH p AS (SELECT doc_id, text, CASE doc_id % 7 WHEN 1 THEN '$' WHEN 2 THEN '![x]()' WHEN 3 THEN '\upmu ' ELSE '<a>' END || substr(text, 4, 2) || '<b>' || substr(text, 6, 2) || substr(text, 10) AS new FROM documents),
 o AS (SELECT *, len(list_filter(string_split(new, chr(10)), lambda x: len(list_filter(regexp_extract_all(replace(x, '\$', ''), '\$+'), lambda d: d = '$')) % 2 = 1)) AS a, len(list_filter(string_split(text, chr(10)), lambda x: len(list_filter(regexp_extract_all(replace(x, '\$', ''), '\$+'), lambda d: d = '$')) % 2 = 1)) AS b FROM p),
 g AS (SELECT *, CASE WHEN doc_id % 10 = 0 THEN 'no_patch' WHEN doc_id % 9 = 0 THEN 'stale_baseline' WHEN length(trim(new, ' ')) = 0 THEN 'nonempty' WHEN a > b THEN 'delimiters' WHEN doc_id % 7 = 2 THEN 'assets' WHEN doc_id % 7 = 3 THEN 'commands' END AS reason FROM o)
 SELECT doc_id, reason IS NULL AS committed, reason, sha256(CASE WHEN reason IS NULL THEN new ELSE text END) AS digest FROM g""",
    "owner_spans": """WITH r AS (SELECT DISTINCT l_orderkey AS page, CAST(l_linenumber % 5 AS INTEGER) AS block_id FROM lineitem),
 g AS (SELECT r.page, r.block_id, count(DISTINCT l_linenumber) AS n, min(l_linenumber) * 10 AS a FROM r LEFT JOIN lineitem l ON l.l_orderkey = r.page AND l.l_linenumber % 4 = r.block_id GROUP BY ALL)
 SELECT page, block_id, CASE WHEN n = 1 THEN a END AS span_start, CASE WHEN n = 1 THEN a + 8 END AS span_end, CASE WHEN n = 1 THEN 'ok' ELSE 'blocker:unlocatable_md_owner' END AS route FROM g""",
    "conversation_markdown": """SELECT conv_id, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn) || chr(10)) AS digest FROM conversations WHERE trim(coalesce(text, ''), ' ') <> '' GROUP BY conv_id""",
    "fused_formulas": """WITH b AS (SELECT conv_id, turn AS pos, (['display_formula', 'formula_number', 'text', 'doc_title', 'paragraph_title'])[turn * 3 % 5 + 1] AS label, CASE WHEN turn % 6 <> 5 THEN 'b' || turn ELSE '' END AS content FROM conversations),
 w AS (SELECT *, lead(label) OVER p AS nl, lead(content) OVER p AS nc, lag(label) OVER p AS pl, lag(content) OVER p AS pc, bool_or(label = 'paragraph_title') OVER (PARTITION BY conv_id) AS title FROM b WINDOW p AS (PARTITION BY conv_id ORDER BY pos))
 SELECT conv_id, pos, CASE WHEN label = 'display_formula' AND nl = 'formula_number' THEN '$$ ' || content || ' \\tag{' || coalesce(nc, '') || '} $$' WHEN label = 'display_formula' THEN '$$ ' || content || ' $$'
  WHEN label = 'paragraph_title' OR (label = 'doc_title' AND title) THEN '## ' || content ELSE content END AS md FROM w WHERE content <> '' AND NOT coalesce(label = 'formula_number' AND pl = 'display_formula' AND pc <> '', false)""".replace("\\\\", "\\"),
    "event_ids": """SELECT DISTINCT user_id AS u, event_type AS t, substr(sha256('{"t":"' || event_type || '","u":' || user_id || '}'), 1, 20) AS id FROM events""",
}
