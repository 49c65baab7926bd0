"""Ordered analytics: ranges, gaps, neighbours, running offsets, interval conflicts, last writes, chunks, samples, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.sources.tables import table


def ranges(df: DataFrame, key: str, page: str) -> DataFrame:
    """Runs of consecutive pages as first, last and 'a-b' text."""
    distinct = df.select(key, page).distinct()
    island = F.col(page) - F.row_number().over(Window.partitionBy(key).orderBy(page))
    runs = distinct.withColumn("_i", island).groupBy(key, "_i").agg(F.min(page).alias("first"), F.max(page).alias("last")).drop("_i")
    return runs.withColumn("range", F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat(F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string"))))


def missing_pages(present: DataFrame, counts: DataFrame, failed: DataFrame, key: str, page: str) -> DataFrame:
    """Expected pages 1..n that are neither present nor failed."""
    expected = counts.select(key, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_pages").cast("long"))).alias(page))
    return expected.join(present.select(key, page), [key, page], "left_anti").join(failed.select(key, page), [key, page], "left_anti")


#: Labels that explain a page without text; limits of the novelty signals.
VISUAL = ("image", "chart", "table", "figure_title")
LEAST_PAGES, LEAST_MEDIAN, LEAST_CHARS, COLLAPSE, NEIGHBOUR, LOOP, LOOP_CHARS, FRONT_PAGES, FRONT_BLOCKS = 3, 100, 20, 0.15, 0.5, 3, 30, 10, 4
BAD = r"[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F]"


def novel_signals(blocks: DataFrame, doc: str, page: str) -> DataFrame:
    """Findings (kind, amount) of pages, given by blocks (source_index, label, in_order, content), in documents of at least three
    pages with text whose median is at least 100 characters.

    novel_page_text_collapse: a page with ordered blocks, no visual one and no sparse front title has fewer than
    max(20, 0.15 median) characters, and the pages before and after have more than half the median; amount is its characters.
    novel_bad_character: replacement or control characters. novel_repeated_block_loop: the longest run, three at least, of
    equal consecutive ordered blocks of 30 or more characters.
    """
    key = [doc, page]
    ordered = blocks.where("in_order").withColumn("_c", F.trim(F.coalesce("content", F.lit(""))))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("in_order"), F.struct("source_index", F.trim(F.coalesce("content", F.lit(""))).alias("c"))))), lambda s: s["c"]), "")
    pages = blocks.groupBy(*key).agg(
        text.alias("_t"), F.count_if("in_order").alias("n"), F.coalesce(F.bool_or(F.col("label").isin(*VISUAL)), F.lit(False)).alias("visual"),
        F.coalesce(F.bool_or((F.col("label") == "doc_title") & F.col("in_order")), F.lit(False)).alias("title"))
    pages = pages.select(*key, "n", "visual", F.length(F.trim("_t")).alias("chars"), F.regexp_count("_t", F.lit(BAD)).alias("bad"), ((F.col(page) <= FRONT_PAGES) & (F.col("n") <= FRONT_BLOCKS) & F.col("title")).alias("front"))
    told = pages.where("chars > 0").groupBy(doc).agg(F.count(F.lit(1)).alias("_n"), F.median("chars").alias("median")).where((F.col("_n") >= LEAST_PAGES) & (F.col("median") >= LEAST_MEDIAN)).select(doc, "median")
    near = lambda d: F.coalesce(F.max("chars").over(Window.partitionBy(doc).orderBy(F.col(page).cast("long")).rangeBetween(d, d)), F.lit(0))
    rows = pages.withColumn("before", near(-1)).withColumn("after", near(1)).join(told, doc)
    low = F.col("chars") < F.greatest(F.lit(float(LEAST_CHARS)), COLLAPSE * F.col("median"))
    collapse = rows.where((F.col("n") > 0) & ~F.col("visual") & ~F.col("front") & low & (F.col("before") > NEIGHBOUR * F.col("median")) & (F.col("after") > NEIGHBOUR * F.col("median")))
    w = Window.partitionBy(*key).orderBy("source_index")
    runs = ordered.withColumn("_new", F.when((F.lag("_c").over(w) == F.col("_c")) & (F.col("_c") != ""), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    runs = runs.where(F.length("_c") >= LOOP_CHARS).groupBy(*key, "_run").agg(F.count(F.lit(1)).alias("k")).groupBy(*key).agg(F.max("k").alias("k")).where(F.col("k") >= LOOP)
    found = collapse.select(*key, F.lit("novel_page_text_collapse").alias("kind"), F.col("chars").cast("long").alias("amount"))
    found = found.unionByName(rows.where("bad > 0").select(*key, F.lit("novel_bad_character").alias("kind"), F.col("bad").cast("long").alias("amount")))
    return found.unionByName(runs.join(told, doc).select(*key, F.lit("novel_repeated_block_loop").alias("kind"), F.col("k").cast("long").alias("amount")))


def repeat_loops(df: DataFrame, key: str, order: list[str], value: str, least: int = 3) -> DataFrame:
    """Runs of at least `least` equal consecutive values."""
    w = Window.partitionBy(key).orderBy(*order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    runs = df.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(key, "run", value).agg(F.count(F.lit(1)).alias("length")).where(F.col("length") >= least)


def running_spans(df: DataFrame, key: str, order: str, length: Column, gap: int = 2, newlines: Column | None = None, crlf: Column | None = None) -> DataFrame:
    """[span_start, span_end) of pieces joined by two newlines; blank pieces have no span. In a document with CRLF every newline
    before a place counts once more: those inside pieces (newlines) and those between them."""
    wide = F.coalesce(crlf, F.lit(False)) if crlf is not None else F.lit(False)
    own = length + F.when(wide, newlines if newlines is not None else F.lit(0)).otherwise(0)
    size = F.when(length > 0, own + F.when(wide, 2 * gap).otherwise(gap)).otherwise(0)
    before = F.coalesce(F.sum(size).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.select(key, order, F.when(length > 0, before).alias("span_start"), F.when(length > 0, before + own).alias("span_end"))


def interval_conflicts(proposals: DataFrame, docs: DataFrame) -> DataFrame:
    """What becomes of each proposal (doc, id, lo, hi, before, replacement) on its document (doc, text): doc, id, verdict.

    In this order: target_out_of_range; target_fingerprint_mismatch, where before is not the SHA-256 of the text it would
    replace; duplicate, where a smaller id has the same span and replacement; shared_insertion_anchor, of two or more
    insertions at one place; overlapping_proposals, of all spans in a chain of overlaps; kept. An insertion overlaps nothing.
    A document's text is sent to its proposals once, as one row.
    """
    packed = proposals.groupBy("doc").agg(F.collect_list(F.struct("id", "lo", "hi", "before", "replacement")).alias("_p"))
    rows = docs.join(packed, "doc")
    text = F.coalesce("text", F.lit(""))
    within = lambda p: (p["lo"] >= 0) & (p["lo"] <= p["hi"]) & (p["hi"] <= F.length(text))
    same = lambda p: F.sha2(F.substring(text, (p["lo"] + 1).cast("int"), (p["hi"] - p["lo"]).cast("int")), 256) == p["before"]
    fault = lambda p: F.when(~within(p), "target_out_of_range").when(~same(p), "target_fingerprint_mismatch")
    rows = rows.select("doc", F.inline(F.transform("_p", lambda p: F.struct(p["id"].alias("id"), p["lo"].alias("lo"), p["hi"].alias("hi"), p["replacement"].alias("replacement"), fault(p).alias("fault")))))
    first = Window.partitionBy("doc", "fault", "lo", "hi", "replacement").orderBy("id")
    rows = rows.withColumn("fault", F.coalesce("fault", F.when(F.row_number().over(first) > 1, "duplicate")))
    good = rows.where("fault IS NULL").drop("fault")
    w = Window.partitionBy("doc").orderBy("lo", "hi", "id")
    wide = good.where("hi > lo").withColumn("_new", F.when(F.col("lo") < F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)), 0).otherwise(1)).withColumn("_c", F.sum("_new").over(w))
    wide = wide.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("doc", "_c"))).select("doc", "id", F.when(F.col("_n") > 1, "overlapping_proposals").otherwise("kept").alias("verdict"))
    points = good.where("hi = lo").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("doc", "lo"))).select("doc", "id", F.when(F.col("_n") > 1, "shared_insertion_anchor").otherwise("kept").alias("verdict"))
    return wide.unionByName(points).unionByName(rows.where("fault IS NOT NULL").select("doc", "id", F.col("fault").alias("verdict")))


def last_write(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in an append-only ledger."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def pending(df: DataFrame, key: str, order: list[Column], status: str, terminal: tuple[str, ...]) -> DataFrame:
    """Batches of an append-only ledger whose last entry is not terminal."""
    return last_write(df, [key], order).where(~F.coalesce(F.col(status).isin(*terminal), F.lit(False)))


#: Parts of the order of a numeric column: two levels of SPLIT bounds each.
SPLIT = 32


def ranks(df: DataFrame, key: str, order: str) -> DataFrame:
    """Adds rank, from 0 inside each key by a numeric order without ties: a row number inside one of 1024 parts of the order, plus
    the rows in earlier parts, so that a key of any share of the rows is no single task's."""
    bounds = df.select(F.percentile_approx(F.col(order).cast("double"), [i / SPLIT**2 for i in range(SPLIT**2)], 10_000)).first()[0] or [0.0]
    upper, lower = [float(bounds[i]) for i in range(0, len(bounds), SPLIT)], [[float(x) for x in bounds[i : i + SPLIT]] for i in range(0, len(bounds), SPLIT)]
    passed = lambda xs: F.size(F.filter(xs, lambda x: x <= F.col(order)))
    hi = F.greatest(passed(F.lit(upper)), F.lit(1))
    rows = df.withColumn("_hi", hi).withColumn("_part", F.col("_hi") * SPLIT + passed(F.element_at(F.lit(lower), F.col("_hi")))).drop("_hi")
    sizes = rows.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    start = sizes.select(F.col(key).alias("_k"), F.col("_part").alias("_q"), (F.sum("_n").over(Window.partitionBy(key).orderBy("_part")) - F.col("_n")).alias("_before"))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_part").orderBy(order)))
    return rows.join(start, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_q"))).withColumn("rank", F.col("_before") + F.col("_r") - 1).drop("_k", "_q", "_part", "_r", "_before")


def chunks(df: DataFrame, key: str, order: str, size: int = 10) -> DataFrame:
    """Fixed-size chunks in a numeric order, with an id that depends on their members' order."""
    rows = ranks(df, key, order).withColumn("chunk", F.expr(f"rank div {size}"))
    members = F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x.cast("string")), "|")
    return rows.groupBy(key, "chunk").agg(F.count(F.lit(1)).alias("n"), members.alias("_m")).select(key, "chunk", "n", F.substring(F.sha2("_m", 256), 1, 12).alias("batch_id"))


def bounded_counts(df: DataFrame, keys: list[str], value: str, limit: int) -> DataFrame:
    """Counts of the most frequent values, ties by value, and the sum of all others as __other__.

    The rank is limited where it is counted, so Spark keeps `limit` rows a partition and key before it shuffles; the
    others are what the total leaves.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    top = counts.withColumn("_r", F.row_number().over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc("n"), value))).where(F.col("_r") <= limit)
    named = top.select(*keys, F.col(value).cast("string").alias("item"), "n")
    signed = named.select(*keys, (-F.col("n")).alias("n")).unionByName(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    rest = signed.groupBy(*keys).agg(F.sum("n").alias("n")).where("n > 0").select(*keys, F.lit("__other__").alias("item"), "n")
    return named.unionByName(rest)


def uniform_sample(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """Rows at positions floor(i n / k) for i below k."""
    rows = df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    taken = F.expr(f"((_r * {k} + _n - 1) div _n) * _n div {k} = _r AND (_r * {k} + _n - 1) div _n < {k}")
    return rows.where(taken | (F.col("_n") <= k)).drop("_r", "_n")


def budget(df: DataFrame, key: str, order: list[Column], limit: int) -> DataFrame:
    """Rows by priority; those past the budget are not routed."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("routed", rank <= limit)


#: States of an event that are final, and those of one that goes to no agent.
TERMINAL = ("resolved", "ignored", "accepted", "rejected")
NO_AGENT, OVER_BUDGET, ROUTED = "unresolved_no_agent", "not_routed_due_budget", "routed"


def route_events(events: DataFrame, prior: DataFrame, batch: str, order: list[str], limit: int, agents: bool = True) -> DataFrame:
    """State of each event (event_id, input_fingerprint) of a batch: that of its prior run where it was final and its input is the same;
    else routed, in order of priority, up to the limit; the rest are over the budget, and without agents none is routed."""
    old = prior.where(F.col("status").isin(*TERMINAL)).select("event_id", F.col("input_fingerprint").alias("_f"), F.col("status").alias("_s"))
    rows = events.join(old, "event_id", "left").withColumn("_s", F.when(F.col("_f") == F.col("input_fingerprint"), F.col("_s")))
    open_ = F.sum(F.when(F.col("_s").isNull(), 1).otherwise(0)).over(Window.partitionBy(batch).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    fresh = F.when(F.lit(not agents), NO_AGENT).when(open_ <= limit, ROUTED).otherwise(OVER_BUDGET)
    return rows.select(*events.columns, F.coalesce("_s", fresh).alias("state"), F.col("_s").isNotNull().alias("reused"))


def sequence_ratio(df: DataFrame, key: str, block: str, rank: Column) -> DataFrame:
    """Share of adjacent blocks whose median rank does not fall; null below two blocks."""
    medians = df.groupBy(key, block).agg(F.median(rank).alias("m"))
    up = F.when(F.lag("m").over(Window.partitionBy(key).orderBy(block)).isNotNull(), (F.col("m") >= F.lag("m").over(Window.partitionBy(key).orderBy(block))).cast("double"))
    return medians.withColumn("up", up).groupBy(key).agg(F.avg("up").alias("ratio"))


def page_ranges(spark, sf_dir):
    """Runs of the pages that suppliers' parts make: the gaps are those of the data."""
    return ranges(table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 53).alias("page")), "l_suppkey", "page")


def missing_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).cast("long").alias("page"))
    counts = turns.groupBy("conv_id").agg(F.max("page").alias("n_pages"))
    return missing_pages(turns.where("page % 5 <> 4"), counts, turns.where("page % 10 = 9"), "conv_id", "page")


def _turn_blocks(spark, sf_dir):
    """Blocks of turns, whose text is cut at stops: some pages collapse, some repeat their first block, some have bad characters."""
    turns = table(spark, sf_dir, "conversations").withColumn("page", F.col("turn") + 1)
    parts = F.split("text", r"\. ")
    parts = F.when((F.col("conv_id") + F.col("turn")) % 7 == 3, F.array_repeat(F.element_at(parts, 1), 4)).otherwise(parts)
    rows = turns.select("conv_id", "page", F.posexplode(parts).alias("source_index", "content"))
    label = F.when((F.col("page") % 8 == 3) & (F.col("source_index") == 0) & (F.col("conv_id") % 2 == 0), "image").when((F.col("page") == 3) & (F.col("source_index") == 0) & (F.col("conv_id") % 3 == 0), "doc_title").otherwise("text")
    content = F.when(F.col("page") % 4 == 3, F.substring("content", 1, 2)).when(F.col("conv_id") % 11 == 0, F.concat("content", F.lit("\ufffd"))).otherwise(F.col("content"))
    return rows.select("conv_id", "page", "source_index", label.alias("label"), ((F.col("source_index") % 6 != 5) | (F.col("page") % 5 == 0)).alias("in_order"), content.alias("content"))


def novel_page_signals(spark, sf_dir):
    return novel_signals(_turn_blocks(spark, sf_dir), "conv_id", "page")


def repeat_loop_events(spark, sf_dir):
    return repeat_loops(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type")


def page_offsets(spark, sf_dir):
    """Spans of order comments, some blank, of two lines each; every third customer's document has CRLF."""
    body = F.when(F.col("o_orderkey") % 7 == 0, 0).otherwise(F.length("o_orderpriority") + 1)
    return running_spans(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", body, newlines=F.lit(1), crlf=F.col("o_custkey") % 3 == 0)


def interval_conflict_events(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    spans = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 150).alias("doc"), F.col("event_id").alias("id"), (F.col("event_id") * 7 % 61).alias("lo"),
        (F.col("event_id") * 7 % 61 + F.pmod(F.floor("value").cast("long"), F.lit(4)) + F.when(F.col("event_id") % 29 == 0, 1000000).otherwise(0)).alias("hi"), F.col("event_type").alias("replacement"))
    text = docs.select(F.col("doc").alias("_d"), F.substring("text", 1, 70).alias("_t"))
    before = F.when(F.col("id") % 11 == 0, "stale").otherwise(F.sha2(F.substring(F.col("_t"), (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int")), 256))
    return interval_conflicts(spans.join(text, F.col("doc") == F.col("_d")).withColumn("before", before).drop("_d", "_t"), docs)


def pending_batches(spark, sf_dir):
    ledger = table(spark, sf_dir, "events").select(F.col("user_id").alias("batch"), "ts", "event_id", F.col("event_type").alias("status"))
    return pending(ledger, "batch", [F.desc("ts"), F.desc("event_id")], "status", ("purchase", "click")).select("batch", "event_id", "status")


def last_write_state(spark, sf_dir):
    return last_write(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


def batch_chunks(spark, sf_dir):
    return chunks(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


def bounded_count_events(spark, sf_dir):
    return bounded_counts(table(spark, sf_dir, "events"), ["event_type"], "user_id", 10)


def bounded_count_sources(spark, sf_dir):
    return bounded_counts(table(spark, sf_dir, "documents"), ["lang"], "source", 5)


def uniform_page_sample(spark, sf_dir):
    return uniform_sample(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 3)


def routing_budget(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return budget(rows, "o_custkey", [F.asc("o_orderpriority"), F.asc("o_orderkey")], 5)


def routed_events(spark, sf_dir):
    k = F.col("o_orderkey")
    events = table(spark, sf_dir, "orders").select("o_custkey", k.alias("event_id"), "o_orderpriority", (k % 5).alias("input_fingerprint"))
    prior = events.where("event_id % 3 = 0").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("input_fingerprint")).otherwise(F.lit(-1)).alias("input_fingerprint"), F.when(F.col("event_id") % 4 == 0, "accepted").otherwise("routed").alias("status"))
    return route_events(events, prior, "o_custkey", ["o_orderpriority", "event_id"], 4).select("o_custkey", "event_id", "state", "reused")


def sequence_ratio_orders(spark, sf_dir):
    return sequence_ratio(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("double"))


QUERIES = {f.__name__: f for f in (page_ranges, missing_turns, novel_page_signals, repeat_loop_events, page_offsets, interval_conflict_events, pending_batches, last_write_state, batch_chunks, bounded_count_events, bounded_count_sources, uniform_page_sample, routing_budget, routed_events, sequence_ratio_orders)}

ORACLE = {
    "page_ranges": """WITH d AS (SELECT DISTINCT l_suppkey, l_partkey % 53 AS page FROM lineitem), i AS (SELECT *, page - row_number() OVER (PARTITION BY l_suppkey ORDER BY page) AS g FROM d)
 SELECT l_suppkey, min(page) AS first, max(page) AS last, CASE WHEN min(page) = max(page) THEN CAST(min(page) AS VARCHAR) ELSE min(page) || '-' || max(page) END AS range FROM i GROUP BY l_suppkey, g""",
    "missing_turns": """WITH t AS (SELECT conv_id, turn + 1 AS page FROM conversations), n AS (SELECT conv_id, max(page) AS n FROM t GROUP BY conv_id)
 SELECT conv_id, page FROM (SELECT conv_id, unnest(range(1, n + 1)) AS page FROM n) e
 WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.conv_id = e.conv_id AND t.page = e.page AND (t.page % 5 <> 4 OR t.page % 10 = 9))""",
    "novel_page_signals": """WITH p AS (SELECT conv_id, turn + 1 AS page, string_split(text, '. ') AS ps, (conv_id + turn) % 7 = 3 AS again FROM conversations),
 q AS (SELECT conv_id, page, CASE WHEN again THEN [ps[1], ps[1], ps[1], ps[1]] ELSE ps END AS ps FROM p), u AS (SELECT conv_id, page, unnest(range(len(ps))) AS i, unnest(ps) AS c FROM q),
 b AS (SELECT conv_id, page, i, CASE WHEN page % 8 = 3 AND i = 0 AND conv_id % 2 = 0 THEN 'image' WHEN page = 3 AND i = 0 AND conv_id % 3 = 0 THEN 'doc_title' ELSE 'text' END AS label, i % 6 <> 5 OR page % 5 = 0 AS o,
  trim(CASE WHEN page % 4 = 3 THEN substr(c, 1, 2) WHEN conv_id % 11 = 0 THEN c || chr(65533) ELSE c END, ' ') AS c FROM u),
 g AS (SELECT conv_id, page, count(*) FILTER (o) AS n, bool_or(label = 'image') AS visual, coalesce(bool_or(label = 'doc_title' AND o), false) AS title, coalesce(string_agg(c, '' ORDER BY i) FILTER (o), '') AS t FROM b GROUP BY ALL),
 s AS (SELECT *, length(trim(t, ' ')) AS chars, length(t) - length(replace(t, chr(65533), '')) AS bad FROM g),
 m AS (SELECT conv_id, median(chars) AS m FROM s WHERE chars > 0 GROUP BY conv_id HAVING count(*) >= 3 AND median(chars) >= 100),
 r AS (SELECT s.*, m, coalesce(a.chars, 0) AS x, coalesce(z.chars, 0) AS y FROM s JOIN m USING (conv_id) LEFT JOIN s a ON a.conv_id = s.conv_id AND a.page = s.page - 1 LEFT JOIN s z ON z.conv_id = s.conv_id AND z.page = s.page + 1),
 w AS (SELECT *, CASE WHEN c <> '' AND lag(c) OVER v = c THEN 0 ELSE 1 END AS new FROM b WHERE o WINDOW v AS (PARTITION BY conv_id, page ORDER BY i)), k AS (SELECT *, sum(new) OVER (PARTITION BY conv_id, page ORDER BY i) AS run FROM w),
 l AS (SELECT conv_id, page, run, count(*) AS k FROM k WHERE length(c) >= 30 GROUP BY ALL HAVING count(*) >= 3)
 SELECT conv_id, page, 'novel_page_text_collapse' AS kind, CAST(chars AS BIGINT) AS amount FROM r WHERE n > 0 AND NOT visual AND NOT (page <= 10 AND n <= 4 AND title) AND chars < greatest(20.0, 0.15 * m) AND x > 0.5 * m AND y > 0.5 * m
 UNION ALL SELECT conv_id, page, 'novel_bad_character', CAST(bad AS BIGINT) FROM r WHERE bad > 0
 UNION ALL SELECT conv_id, page, 'novel_repeated_block_loop', CAST(max(k) AS BIGINT) FROM l JOIN m USING (conv_id) GROUP BY conv_id, page""",
    "repeat_loop_events": """WITH n AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 r AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM n)
 SELECT user_id, run, event_type, count(*) AS length FROM r GROUP BY ALL HAVING count(*) >= 3""",
    "page_offsets": """WITH l AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE length(o_orderpriority) + 1 END AS n, o_custkey % 3 = 0 AS w FROM orders),
 z AS (SELECT *, n + CASE WHEN w THEN 1 ELSE 0 END AS own FROM l),
 s AS (SELECT *, coalesce(sum(CASE WHEN n > 0 THEN own + CASE WHEN w THEN 4 ELSE 2 END ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM z)
 SELECT o_custkey, o_orderkey, CAST(CASE WHEN n > 0 THEN b END AS BIGINT) AS span_start, CAST(CASE WHEN n > 0 THEN b + own END AS BIGINT) AS span_end FROM s""",
    "interval_conflict_events": """WITH e AS (SELECT user_id % 150 AS doc, event_id AS id, event_id * 7 % 61 AS lo, event_id * 7 % 61 + ((CAST(floor(value) AS BIGINT) % 4) + 4) % 4 + CASE WHEN event_id % 29 = 0 THEN 1000000 ELSE 0 END AS hi, event_type AS rep FROM events),
 p AS (SELECT e.*, text, CASE WHEN hi > length(text) THEN 'target_out_of_range' WHEN id % 11 = 0 OR substr(text, lo + 1, hi - lo) <> substr(substr(text, 1, 70), lo + 1, hi - lo) THEN 'target_fingerprint_mismatch' END AS fault FROM e JOIN documents ON doc_id = doc),
 f AS (SELECT *, coalesce(fault, CASE WHEN row_number() OVER (PARTITION BY doc, fault, lo, hi, rep ORDER BY id) > 1 THEN 'duplicate' END) AS bad FROM p), k AS (SELECT doc, id, lo, hi FROM f WHERE bad IS NULL)
 SELECT doc, id, coalesce(bad, CASE WHEN lo = hi AND (SELECT count(*) FROM k WHERE k.doc = f.doc AND k.lo = f.lo AND k.hi = f.hi) > 1 THEN 'shared_insertion_anchor'
  WHEN EXISTS (SELECT 1 FROM k WHERE k.doc = f.doc AND k.id <> f.id AND greatest(k.lo, f.lo) < least(k.hi, f.hi)) THEN 'overlapping_proposals' ELSE 'kept' END) AS verdict FROM f""",
    "pending_batches": """WITH l AS (SELECT user_id AS batch, event_id, event_type AS status FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) SELECT * FROM l WHERE status NOT IN ('purchase', 'click')""",
    "last_write_state": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
    "batch_chunks": """WITH c AS (SELECT o_orderpriority, o_orderkey, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 10 AS chunk FROM orders)
 SELECT o_orderpriority, chunk, count(*) AS n, substr(sha256(string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderkey)), 1, 12) AS batch_id FROM c GROUP BY ALL""",
    "bounded_count_events": """WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS r FROM c)
 SELECT event_type, CASE WHEN r <= 10 THEN CAST(user_id AS VARCHAR) ELSE '__other__' END AS item, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY ALL""",
    "bounded_count_sources": """WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS r FROM c)
 SELECT lang, CASE WHEN r <= 5 THEN source ELSE '__other__' END AS item, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY ALL""",
    "uniform_page_sample": """WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
 SELECT o_custkey, o_orderkey FROM r WHERE n <= 3 OR r IN (0, n // 3, 2 * n // 3)""",
    "routing_budget": "SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) <= 5 AS routed FROM orders",
    "routed_events": """WITH e AS (SELECT o_custkey, o_orderkey AS k, o_orderpriority, o_orderkey % 12 = 0 AS reused FROM orders), r AS (SELECT *, sum(CASE WHEN reused THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, k) AS n FROM e)
 SELECT o_custkey, k AS event_id, CASE WHEN reused THEN 'accepted' WHEN n <= 4 THEN 'routed' ELSE 'not_routed_due_budget' END AS state, reused FROM r""",
    "sequence_ratio_orders": """WITH m AS (SELECT l_orderkey, l_linenumber, median(CAST(l_suppkey AS DOUBLE)) AS m FROM lineitem GROUP BY ALL),
 u AS (SELECT l_orderkey, CASE WHEN lag(m) OVER w IS NOT NULL THEN CAST(m >= lag(m) OVER w AS DOUBLE) END AS up FROM m WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
 SELECT l_orderkey, avg(up) AS ratio FROM u GROUP BY l_orderkey""",
}
