"""Substring dedup by relative Lempel-Ziv parsing against an index of reference blocks.

What goes: every word covered by a window of WINDOW consecutive words whose word sequence also starts in a
document with a smaller doc_id, judged on the input.

Reference blocks. In each window the leftmost SEED-word gram with the smallest hash is its anchor, which
depends on the window's words alone; the windows of one anchor follow each other, and the words they
cover are a block. About one word in 22 starts a block, so the index of all blocks of all documents
(anchor hash, block hash, smallest doc_id) has that share of the corpus's words as rows.

Greedy parse. A document's factors are its runs of blocks. A block that occurs in an earlier document is
copied whole: all its windows match. The first owner of a block has no whole copy; where its anchor is
shared with another block (a copy that starts, ends or is edited inside the block) it is at a factor
boundary, and there windows are checked one by one by their own hashes against those of the other owners
of that anchor's blocks. An owner stands for all later copies of its block, so a passage in any number of
documents costs one block for each, and a boundary check for each distinct neighbourhood only. Factors of at
least WINDOW words are exactly the runs of matching windows; their union is removed.

Hashes: two independent 64-bit polynomials over bytes and over words.

Defined results: a very long text is parsed whole, in memory of a multiple of its size; of documents with a window in common
the one with the smallest identifier keeps it, and a document's own repeats stay; extra columns may have any name, also
those used inside; words are split at ASCII white space and kept unchanged; a null text has no words; rows with
a null doc_id are neither changed nor a reference; rows with the same doc_id are no reference to each other;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bin_values, map_text, materialize, widened

WINDOW = 50
SEED = 8
STRETCH = 64
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_U = np.uint64
_SIDE = 0x5555555555555555


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


#: White space that separates words: the space and U+0009 to U+000D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _word_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each word: polynomials over its bytes."""
    return [_mix(_polynomial(data, start, size, _U(m))) for m in _MULTIPLIERS]


def _polynomial(values: np.ndarray, start: np.ndarray, size: np.ndarray, m: np.uint64) -> np.ndarray:
    """Polynomials over stretches of values, all stretches' k-th values at once, longest first. A stretch of over STRETCH values is
    one over the polynomials of its parts of that size, so steps grow with the logarithm of the longest."""
    out = np.empty(len(size), dtype=_U)
    long = size > STRETCH
    if long.any():
        parts = -(-size[long] // STRETCH)
        own = np.repeat(np.arange(len(parts)), parts)
        k = np.arange(len(own)) - (np.cumsum(parts) - parts)[own]
        inner = _polynomial(values, start[long][own] + k * STRETCH, np.minimum(size[long][own] - k * STRETCH, STRETCH), m)
        out[long] = _polynomial(inner, np.cumsum(parts) - parts, parts, m) * m + size[long].astype(_U)
        start, size = start[~long], size[~long]
    order = np.argsort(-size, kind="stable")
    at, sums = start[order], size[order].astype(_U)
    left = np.searchsorted(-size[order], -np.arange(1, size.max(initial=0) + 1), side="right")
    for k, n in enumerate(left.tolist()):
        sums[:n] = sums[:n] * m + values[at[:n] + k]
    short = np.empty_like(sums)
    short[order] = sums
    out[~long] = short
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of m and of its inverse, modulo 2^64."""
    have = _POWERS.get(m)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(m, -1, 1 << 64)
        have = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, dtype=_U), np.full(size, x, dtype=_U)])) for x in (m, inverse))
        _POWERS[m] = have
    return have


class Stream:
    """The words of several documents one after another, with hashes of any stretch of them."""

    def __init__(self, texts: list[bytes | None]):
        raw = b"\n".join(x or b"" for x in texts) + b"\n"
        data = np.frombuffer(raw, dtype=np.uint8)
        word = ~_SPACE[data]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            edge = np.concatenate([[0], edge])
        start, stop = edge[::2], edge[1::2]
        self.n = len(start)
        self.ends = np.searchsorted(start, np.cumsum([len(x or b"") + 1 for x in texts]))
        self.sums, self.back = [], []
        for h, m in zip(_word_hashes(data, start, stop - start), _MULTIPLIERS, strict=True):
            up, down = _powers(m, self.n + 1)
            self.sums.append(np.concatenate([np.zeros(1, dtype=_U), np.cumsum(h * up[: self.n], dtype=_U)]))
            self.back.append(down)

    def hash(self, which: int, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[which][end] - self.sums[which][at]) * self.back[which][at]

    def blocks(self, window: int, seed: int):
        """Of every block: document, first window, past last window, anchor hash, block hash."""
        none = np.zeros(0, dtype=np.int64)
        if self.n < window:
            return none, none, none, none, none
        at = np.arange(self.n - seed + 1)
        v = _mix(self.hash(0, at, at + seed))
        i = at.astype(np.int32)
        width, span = window - seed + 1, 1

        def least(v, i, step):
            later = v[step:] < v[:-step]
            return np.where(later, v[step:], v[:-step]), np.where(later, i[step:], i[:-step])

        while span * 2 <= width:
            v, i = least(v, i, span)
            span *= 2
        if span < width:
            v, i = least(v, i, width - span)
        starts = np.concatenate([[0], self.ends[:-1]])
        counts = np.maximum(self.ends - starts - window + 1, 0)
        doc = np.repeat(np.arange(len(counts)), counts)
        first = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        if not len(first):
            return none, none, none, none, none
        anchor = i[first].astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
        lo, hi = first[cut], first[np.append(cut[1:] - 1, len(first) - 1)] + 1
        anchor = anchor[cut]
        long = (hi - lo).astype(_U) * _U(1 << 20) + (anchor - lo).astype(_U)
        whole = _mix(self.hash(1, lo, hi - 1 + window) + _mix(long))
        gram = _mix(self.hash(0, anchor, anchor + seed) ^ _mix(self.hash(1, anchor, anchor + seed)))
        return doc[cut], lo, hi, gram.view(np.int64), whole.view(np.int64)


def _stream(batch: pa.RecordBatch, text: str) -> Stream:
    return Stream(bin_values(batch.column(text)))


def block_index(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, gram, whole for every block of every document (columns doc_id and text)."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, _, _, gram, whole = _stream(batch, "text").blocks(window, seed)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[doc]
        return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(gram), pa.array(whole)], ["doc_id", "gram", "whole"])

    return map_text(docs, "text", f, "doc_id long, gram long, whole long")


class _Lookup:
    """Which (row, a, b) triples a list column holds, looked up for whole arrays at once."""

    def __init__(self, column: pa.Array, fields: tuple[str, ...]):
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        counts = np.array([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64) if lists.null_count else np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.values = [flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields]
        self.any = counts > 0
        key = self._key(self.row, self.values[0], self.values[1])
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]

    @staticmethod
    def _key(row, a, b):
        return _mix(_mix(a.view(_U) + row.astype(_U) * _U(_MULTIPLIERS[0])) ^ b.view(_U))

    def find(self, row: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Position among the listed values, or -1."""
        if not len(self.key) or not len(row):
            return np.full(len(row), -1)
        key = self._key(row, a, b)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        got = self.order[at]
        ok = (self.key[at] == key) & (self.row[got] == row) & (self.values[0][got] == a) & (self.values[1][got] == b)
        return np.where(ok, got, -1)


def _boundary_windows(stream: Stream, lo: np.ndarray, hi: np.ndarray, window: int):
    """All windows from lo to before hi of each block: block, start, two hashes."""
    n = hi - lo
    block = np.repeat(np.arange(len(lo)), n)
    at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    return block, at, _mix(stream.hash(0, at, at + window)).view(np.int64), _mix(stream.hash(1, at, at + window)).view(np.int64)


_STATES = "array<struct<gram: long, whole: long, check: int>>"
_HITS = "array<struct<one: long, two: long>>"


def _window_rows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id and hashes of all windows at factor boundaries."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        states = _Lookup(batch.column("states"), ("gram", "whole", "check"))
        doc_ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.unique(states.row[states.values[2] == 1])
        if not len(rows):
            return pa.RecordBatch.from_pylist([], schema=pa.schema([(c, pa.int64()) for c in ("doc_id", "one", "two")]))
        stream = Stream(bin_values(batch.column("text").take(pa.array(rows))))
        doc, lo, hi, gram, whole = stream.blocks(window, seed)
        at = states.find(rows[doc], gram, whole)
        check = np.flatnonzero(at >= 0)
        check = check[states.values[2][at[check]] == 1]
        block, _, one, two = _boundary_windows(stream, lo[check], hi[check], window)
        return pa.RecordBatch.from_arrays([pa.array(doc_ids[rows[doc[check][block]]]), pa.array(one), pa.array(two)], ["doc_id", "one", "two"])

    return map_text(docs, "text", f, "doc_id long, one long, two long")


def _removed(batch: pa.RecordBatch, window: int, seed: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each row, the rows' ends, and which words go."""
    split = [(x or b"").split() for x in bin_values(batch.column("text"))]
    states = _Lookup(batch.column("states"), ("gram", "whole", "check"))
    ends = np.cumsum([len(x) for x in split])
    cover = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    if states.any.any():
        stream = _stream(batch, "text")
        doc, lo, hi, gram, whole = stream.blocks(window, seed)
        at = states.find(doc, gram, whole)
        known = np.flatnonzero(at >= 0)
        check = states.values[2][at[known]]
        copied, checked = known[check == 0], known[check == 1]
        np.add.at(cover, lo[copied], 1)
        np.add.at(cover, hi[copied] - 1 + window, -1)
        hits = _Lookup(batch.column("hits"), ("one", "two"))
        if len(checked) and hits.any.any():
            block, start, one, two = _boundary_windows(stream, lo[checked], hi[checked], window)
            start = start[hits.find(doc[checked][block], one, two) >= 0]
            np.add.at(cover, start, 1)
            np.add.at(cover, start + window, -1)
    return split, ends, np.cumsum(cover[:-1]) > 0


def with_removed(docs: DataFrame, finish, schema, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """finish(batch, words, ends, gone) over all rows; docs has the columns doc_id (long) and text, and any others."""
    blocks = materialize(block_index(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), window, seed))  # read twice, parsed once
    # Anchors of more than one document; partial sums come first, so a common one is a row a task.
    grams = blocks.groupBy("gram").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("hi > lo")
    # Joined by another expression than it was summed by, each side gets an exchange of its own, which Spark may split where hot.
    other = F.col("gram").bitwiseXOR(F.lit(_SIDE))
    shared = materialize(blocks.withColumn("_o", other).join(grams.select(other.alias("_o")), "_o", "left_semi").drop("_o"))
    # A block's key is (whole, gram ^ whole): it is not partitioned like gram, so joins by gram end in an exchange and may be split.
    shared = shared.withColumn("key", F.col("gram").bitwiseXOR(F.col("whole")))
    owners = shared.groupBy("whole", "key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    owners = owners.withColumn("gram", F.col("key").bitwiseXOR(F.col("whole")))
    mixed = owners.groupBy("gram").agg(F.min("whole").alias("a"), F.max("whole").alias("b")).where("a <> b").select(other.alias("g"))
    owners = owners.join(mixed, other == F.col("g"), "left").where("g IS NOT NULL OR last > owner")
    owners = owners.select(F.col("whole").alias("w"), F.col("key").alias("k"), "owner", F.col("g").isNotNull().alias("mixed"))
    states = shared.join(owners, (F.col("whole") == F.col("w")) & (F.col("key") == F.col("k")))
    states = states.where("doc_id > owner OR mixed").select("doc_id", "gram", "whole", (F.col("doc_id") == F.col("owner")).cast("int").alias("check"))
    states = materialize(states.groupBy("doc_id").agg(F.collect_set(F.struct("gram", "whole", "check")).alias("states")))
    states = states.select(F.col("doc_id").alias("_sid"), "states")
    # Both uses of `first` read the same columns of the same join, so the texts are shuffled once and the exchange is used again.
    first = docs.join(states, docs["doc_id"] == states["_sid"], "left").drop("_sid")
    first = first.withColumn("states", F.coalesce("states", F.expr(f"cast(array() as {_STATES})")))
    windows = _window_rows(first, window, seed)
    least = windows.groupBy("one", "two").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("hi > lo")
    least = least.select(F.col("one").alias("o"), F.col("two").alias("t"), "lo")
    hits = windows.join(least, (F.col("one") == F.col("o")) & (F.col("two") == F.col("t")) & (F.col("doc_id") > F.col("lo")))
    hits = hits.groupBy("doc_id").agg(F.collect_set(F.struct("one", "two")).alias("hits")).select(F.col("doc_id").alias("_hid"), "hits")
    both = first.join(hits, first["doc_id"] == hits["_hid"], "left").drop("_hid")
    both = both.withColumn("hits", F.coalesce("hits", F.expr(f"cast(array() as {_HITS})")))

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        return finish(batch, *_removed(batch, window, seed))

    return map_text(both, "text", f, schema)


def _kept(split, ends, gone):
    for words, end in zip(split, ends.tolist(), strict=True):
        mine = gone[end - len(words) : end]
        n = int(mine.sum())
        yield n, words if not n else [w for w, g in zip(words, mine.tolist(), strict=True) if not g]


def removal_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""

    def finish(batch, split, ends, gone):
        kept = list(_kept(split, ends, gone))
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len(x) for x in split], pa.int64()), pa.array([n for n, _ in kept], pa.int64()),
            pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for _, w in kept], pa.string()),
        ], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_removed(rows, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", window, seed)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """df with repeated passages cut from its texts; a text that loses nothing stays as it was, others are
    their kept words joined by a space."""
    names = [c for c in df.columns if c != text_col]
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))

    def finish(batch, split, ends, gone):
        texts = batch.column("text").to_pylist()
        new = [t if not n else b" ".join(w).decode() for t, (n, w) in zip(texts, _kept(split, ends, gone), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], ["row", "text"])

    out = with_removed(rows, finish, widened([rows.schema["row"]], text="string"), window, seed)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in df.columns])


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return removal_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM s),
f AS (SELECT k, min(doc_id) AS first FROM h GROUP BY k),
c AS (SELECT DISTINCT doc_id, i + j AS pos FROM (SELECT h.doc_id, h.i FROM h JOIN f USING (k) WHERE first < doc_id), range(50) t(j)),
g AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id),
r AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END AS kept
      FROM w LEFT JOIN g ON g.doc_id = w.doc_id)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM r
"""
