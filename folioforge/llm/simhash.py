"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint's bit is set where over half of the hashes of the document's word shingles set it.
Documents link where fingerprints differ in at most RADIUS bits; a component is what links reach.

Search. Only distinct fingerprints are searched. The 64 bits are cut into BLOCKS blocks; two linked
fingerprints differ in at most RADIUS of them and agree in the others, so every pair meets in a unit keyed by
some BLOCKS - RADIUS blocks and their bits (21 or 22 bits), and units are what the cluster deals out. Inside a
unit fingerprints are sorted by Gray rank, where neighbours share leading bits, and a tree is built over them: a
node holds the mask and the value of the bits that all its members share. A tree with itself, or two of them, are
searched from the top: a pair of nodes is dropped, with all pairs below it, once the shared bits alone differ
in more than RADIUS places; it is accepted whole once the shared bits' differences and all unshared bits
together are RADIUS or fewer; a pair whose members are already in one component is not opened. The trees of all
units of a batch are built and searched together, level by level, whatever the units' sizes. A unit returns a
forest (an edge for each member at most), never its pairs.

Hot units. A unit of more than UNIT fingerprints is dealt in slices, and every two slices meet in a unit
of their own; no unit holds more than two slices, and no link is lost.

Copies of a row: one for each of the 15 unit keys, at any input size, as long as units hold UNIT fingerprints or
fewer, which they do on average up to eight thousand million distinct ones; above, slices add copies.

Defined results: very long texts are hashed in steps of bounded memory; ties do not arise, since a component's
identifier is its smallest; columns of the input other than the identifier and the text play no part and may
have any name; a null, empty or blank text has fingerprint zero, which links like any other; fewer words
than a shingle make one shingle of all words; component_id is the smallest non-null doc_id reachable
(null if there is none); rows that repeat get the same component; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bin_values, free_name, map_text, materialize, widened
from .links import components

RADIUS = 4
SHINGLE = 4
HASH_SEED = 42
UNIT = 4096
FAN = 8
BLOCKS = 6
#: Hot unit keys are broadcast up to this number (16 MB), and joined by a shuffle beyond it.
BROADCAST_ROWS = 1 << 20
#: Wide fingerprints, for similarities that 64 bits cannot tell from chance.
WIDE, WIDE_RADIUS, TABLES, SAMPLE_BITS = 4, 56, 54, 14
#: Least Jaccard similarity of two similar texts, as a fraction, and the shingles that a slice of a component holds (8 MB).
SIMILAR, SLICE = (4, 5), 1 << 20
_PAIRS = 1 << 19
_SIDE = 0x5555555555555555


def shingle_digests(text: bytes | None, shingle: int = SHINGLE) -> list[bytes]:
    """XXH64 digests of a text's word shingles, A-Z lower-cased; fewer words than a shingle make one, none make none."""
    split = (text or b"").lower().split()
    n = len(split)
    if not n:
        return []
    joined = b" ".join(split)
    digest = xxhash.xxh64_digest
    if n <= shingle:
        return [digest(joined, HASH_SEED)]
    size = np.fromiter(map(len, split), dtype=np.int64, count=n)
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: n - shingle + 1].tolist()
    stop = end[shingle - 1 :].tolist()
    return [digest(joined[a:b], HASH_SEED) for a, b in zip(start, stop, strict=True)]


def fingerprint(text: bytes | None, shingle: int = SHINGLE, words: int = 1) -> list[int]:
    """SimHash of a text in UTF-8, A-Z lower-cased, as unsigned 64-bit words. The first word's hashes are XXH64 of the
    shingles; those of further words are mixed from them. One word counts a shingle as often as it occurs, several count
    it once, as the Jaccard similarity does."""
    hashes = shingle_digests(text, shingle)
    if not hashes:
        return [0] * words
    if words > 1:
        hashes = list(set(hashes))
    sums = np.zeros((words, 64), dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.frombuffer(b"".join(hashes[i : i + (1 << 14)]), dtype=">u8")
        for j in range(words):
            own = part if not j else _remix(part.astype(np.uint64), j).astype(">u8")
            sums[j] += np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * sums > len(hashes), axis=1)
    return [int.from_bytes(x.tobytes(), "big") for x in bits]


def _remix(h: np.ndarray, j: int) -> np.ndarray:
    h = h ^ np.uint64(j * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def with_fingerprint(df: DataFrame, text_col: str, shingle: int = SHINGLE, words: int = 1) -> DataFrame:
    """df without its text, with the fingerprint as signed longs w0, w1, ..."""
    fields = [f for f in df.schema.fields if f.name != text_col]
    names = [f.name for f in fields]
    new = [f"w{j}" for j in range(words)]

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x, shingle, words) for x in bin_values(batch.column(text_col))], dtype=np.uint64).reshape(-1, words).view(np.int64)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(np.ascontiguousarray(fps[:, j])) for j in range(words))], [*names, *new])

    return map_text(df, text_col, f, widened(fields, **{x: "long" for x in new}))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a code in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=1, dtype=np.int64)


class GrayTrees:
    """A Gray tree for each group of codes, all in the same levels, leaves first: the mask and the value that a node's
    members share, its first member and past its last, its first child and past its last. Groups are numbered from 0 and
    none is empty; at the top, node g is all of group g. Codes are rows of 64-bit words, ordered by their words' Gray ranks."""

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        self.order = np.lexsort([*(gray_rank(codes[:, j]) for j in range(codes.shape[1]))][::-1] + [group])
        codes = codes[self.order]
        at = np.arange(len(codes))
        size = np.bincount(group)
        self.levels = [(np.full(codes.shape, ~np.uint64(0)), codes, at, at + 1, at, at)]
        while size.max(initial=0) > 1:
            mask, value, lo, hi, _, _ = self.levels[-1]
            start = np.cumsum(size) - size
            size = -(-size // FAN)
            own = np.repeat(np.arange(len(size)), size)
            cut = start[own] + (np.arange(len(own)) - (np.cumsum(size) - size)[own]) * FAN
            end = np.append(cut[1:], len(mask))
            shared = np.bitwise_and.reduceat(mask & ~(value ^ np.repeat(value[cut], end - cut, axis=0)), cut, axis=0)
            self.levels.append((shared, value[cut] & shared, lo[cut], hi[end - 1], cut, end))


class Forest:
    """Least-member labels of joined positions."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.label[u], self.label[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up

    def one(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The label that positions lo to hi all have, or -1."""
        out = np.full(len(lo), -1)
        change = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])
        same = change[hi - 1] == change[lo]
        out[same] = self.label[lo[same]]
        return out


def to_least(u: np.ndarray, v: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest's edges (member, label) as edges from ids to the least id of their component. Units that hold parts of one
    group then mostly name the same few ids, so that their edges repeat and distinct() drops them."""
    label = np.arange(len(ids))
    label[u] = v
    least = ids.copy()
    np.minimum.at(least, label, ids)
    to = least[label]
    other = to != ids
    return ids[other], to[other]


def join_trees(trees: GrayTrees, a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, member whose label it has) of a forest over all links between groups a[i] and b[i] (a[i] <= b[i]; a group
    with itself where they are equal). Members count in the order in which codes were given."""
    bits = 64 * trees.levels[0][1].shape[1]
    forest = Forest(len(trees.order))
    stack = [(len(trees.levels) - 1, a, b)]
    while stack:
        level, a, b = stack.pop()
        mask, value, lo, hi, child, past = trees.levels[level]
        both = mask[a] & mask[b]
        apart = _ones((value[a] ^ value[b]) & both)
        near = apart <= radius
        a, b, both, apart = a[near], b[near], both[near], apart[near]
        whole = apart + bits - _ones(both) <= radius
        if whole.any():
            x, y = a[whole], b[whole]
            for first, last, to in ((lo[x], hi[x], lo[y]), (lo[y], hi[y], lo[x])):
                reps = last - first
                forest.link(np.repeat(first - np.cumsum(reps) + reps, reps) + np.arange(reps.sum()), np.repeat(to, reps))
            a, b = a[~whole], b[~whole]
        if not level or not len(a):
            continue
        of = forest.one(lo, hi)
        todo = (of[a] < 0) | (of[a] != of[b])
        a, b = a[todo], b[todo]
        step = _PAIRS // FAN**2
        for s in range(0, len(a), step):
            x = np.repeat(child[a[s : s + step], None] + np.arange(FAN), FAN, axis=1)
            y = np.tile(child[b[s : s + step], None] + np.arange(FAN), (1, FAN))
            ok = (x < past[a[s : s + step], None]) & (y < past[b[s : s + step], None]) & (x <= y)
            if ok.any():
                stack.append((level - 1, x[ok], y[ok]))
    linked = np.flatnonzero(forest.label != np.arange(len(trees.order)))
    return trees.order[linked], trees.order[forest.label[linked]]


def block_keys(radius: int = RADIUS, blocks: int = BLOCKS) -> list[Column]:
    """Unit keys of one-word fingerprints: the bits of each choice of blocks - radius blocks, one of which two linked fingerprints
    share; one more than radius at least."""
    blocks = max(blocks, radius + 1)
    ends = [64 * i // blocks for i in range(blocks + 1)]
    bits = [(F.shiftrightunsigned("w0", 64 - hi).bitwiseAND(F.lit((1 << (hi - lo)) - 1)), hi - lo) for lo, hi in zip(ends, ends[1:], strict=False)]
    out = []
    for chosen in combinations(bits, blocks - radius):
        key = F.lit(0).cast("long")
        for part, width in chosen:
            key = F.shiftleft(key, width).bitwiseOR(part)
        out.append(key)
    return out


def bit_samples() -> np.ndarray:
    """TABLES samples of SAMPLE_BITS bit positions of a wide fingerprint, cut from seeded shuffles of all positions, so that
    the samples of one shuffle share no bit."""
    out: list[list[int]] = []
    turn = 0
    while len(out) < TABLES:
        order = sorted(range(64 * WIDE), key=lambda i: xxhash.xxh64_intdigest(f"{turn}:{i}", HASH_SEED))
        out += [order[k : k + SAMPLE_BITS] for k in range(0, len(order) - SAMPLE_BITS + 1, SAMPLE_BITS)]
        turn += 1
    return np.array(out[:TABLES])


def with_samples(fps: DataFrame) -> DataFrame:
    """id, w0, ... of wide fingerprints, with their bits at bit_samples() as the array samples."""
    code = [f"w{j}" for j in range(WIDE)]
    at = bit_samples()
    weight = 1 << np.arange(SAMPLE_BITS, dtype=np.int32)

    def run(batches):
        for b in batches:
            words = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in code], axis=1).astype(">i8")
            bits = np.unpackbits(words.view(np.uint8).reshape(len(words), -1), axis=1)
            keys = np.stack([bits[:, x] @ weight for x in at], axis=1).astype(np.int32)
            ends = pa.array(np.arange(len(words) + 1, dtype=np.int32) * TABLES)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", *code)), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], ["id", *code, "samples"])

    return fps.select("id", *code).mapInArrow(run, "id long, " + ", ".join(f"{c} long" for c in code) + ", samples array<int>")


def wide_keys() -> list[Column]:
    """Unit keys of with_samples(): TABLES samples of SAMPLE_BITS bits."""
    return [F.col("samples")[t].cast("long") for t in range(TABLES)]


def _units(radius: int, words: int):
    names = ["k", "x", "y", "side", "id", *(f"w{j}" for j in range(words))]

    def run(batches):
        """Rows come sorted by unit; a unit is held in memory while it is searched."""
        rest = None
        for b in batches:
            rows = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
            if rest is not None:
                rows = [np.concatenate(z) for z in zip(rest, rows, strict=True)]
            if not len(rows[0]):
                continue
            change = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1])) + 1
            cut = [0, *change.tolist()]
            rest = [z[cut[-1] :] for z in rows]
            yield from found(rows, cut)
        if rest is not None:
            yield from found(rest, [0, len(rest[0])])

    def found(rows, cut):
        if len(cut) < 2:
            return
        rows = [z[: cut[-1]] for z in rows]
        _, x, y, side, ids = rows[:5]
        size = np.diff(cut)
        unit = np.repeat(np.arange(len(size)), size)
        cross = x != y
        # A group is a unit, or either side of one where two slices meet; units of one row or one side have no pairs.
        half = unit * 2 + np.where(cross, side, 0)
        here = np.unique(half)
        pair = here[(here % 2 == 0) & np.isin(here + 1, here)]
        alone = np.flatnonzero(~cross[np.asarray(cut[:-1])] & (size > 1)) * 2
        left, right = np.concatenate([alone, pair]), np.concatenate([alone, pair + 1])
        wanted = np.isin(half, np.concatenate([left, right]))
        if not wanted.any():
            return
        groups, group = np.unique(half[wanted], return_inverse=True)
        codes = np.stack([z[wanted] for z in rows[5:]], axis=1).view(np.uint64)
        u, v = join_trees(GrayTrees(codes, group), np.searchsorted(groups, left), np.searchsorted(groups, right), radius)
        if len(u):
            u, v = to_least(u, v, ids[wanted])
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def link_edges(fps: DataFrame, keys: list[Column], radius: int = RADIUS, words: int = 1, unit: int = UNIT) -> DataFrame:
    """Edges u, v between ids whose components are those of all links found between the distinct fingerprints of fps
    (columns id, w0, ...)."""
    code = [f"w{j}" for j in range(words)]
    tagged = F.array(*[F.lit(t).cast("long") * (1 << 40) + k for t, k in enumerate(keys)])
    rows = fps.select("id", *code, F.explode(tagged).alias("k"))
    hot = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > unit)
    hot = materialize(hot.select("k", F.ceil(F.col("n") / unit).cast("int").alias("c")))
    rows = rows.join(F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot, "k", "left").withColumn("c", F.coalesce("c", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("c")).cast("int"))
    rows = rows.select("k", "id", *code, "own", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("other"))
    rows = rows.select("k", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("int").alias("side"), "id", *code)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "k", "x", "y").sortWithinPartitions("k", "x", "y").mapInArrow(_units(radius, words), "u long, v long")


def _grouped(df: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, words: int) -> DataFrame:
    """doc_id, text_hash, w0, ... (signed), root, component_id for every row; root names the component."""
    code = [f"w{j}" for j in range(words)]
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    rows = materialize(with_fingerprint(rows, "text", shingle, words)).withColumn("id", F.col("w0") if words == 1 else F.xxhash64(*code))
    # Wide codes go by a 64-bit id: two that share one by chance (2.7 pairs among 10^10) count as one candidate.
    distinct = rows.groupBy("id").agg(F.min(F.struct(*code)).alias("_c"), F.min("doc_id").alias("_least"))
    fps = distinct.select("id", "_c.*")
    linked = components(link_edges(fps, block_keys(radius), radius) if words == 1 else link_edges(with_samples(fps), wide_keys(), radius, words))
    named = distinct.join(linked, distinct["id"] == linked["node"], "left").select("id", "_least", F.coalesce("root", "id").alias("root"))
    # Joined by another expression than it was summed by, each side gets an exchange of its own, which Spark may split where a root is hot.
    side = F.col("root").bitwiseXOR(F.lit(_SIDE))
    least = named.groupBy("root").agg(F.min("_least").alias("component_id")).select(side.alias("r"), "component_id")
    named = named.withColumn("r", side).join(least, "r").select("id", "root", "component_id")
    return rows.join(named, "id").select("doc_id", "text_hash", *code, "root", "component_id")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, words: int = 1) -> DataFrame:
    """doc_id, text_hash, w0, ... (signed), component_id for every row.

    One-word fingerprints are searched exactly. Wide ones (WIDE words) are searched in the units of TABLES bit
    samples and compared in all their bits.
    """
    return _grouped(df, id_col, text_col, shingle, radius, words).drop("root")


def _first_of_each(df: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row with the smallest identifier of each root of groups (doc_id, text_hash, root), with all columns of df.

    The join's keys are the window's, so texts move once.
    """
    again, i, n, h, i2, n2, h2 = free_name(df, "again", "_id", "_none", "_hash", "_id2", "_none2", "_hash2")
    kept = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("k"))
    kept = kept.select(F.coalesce("k.doc_id", F.lit(0)).alias(i2), F.col("k.n").alias(n2), F.col("k.text_hash").alias(h2))
    ident = F.col(id_col).cast("long")
    rows = df.select("*", F.coalesce(ident, F.lit(0)).alias(i), ident.isNull().alias(n), F.xxhash64(text_col).alias(h))
    both = rows.join(kept, (F.col(i) == F.col(i2)) & (F.col(n) == F.col(n2)) & (F.col(h) == F.col(h2)))
    first = Window.partitionBy(i, n, h).orderBy(F.lit(0))
    return both.withColumn(again, F.row_number().over(first)).where(F.col(again) == 1).select(*[F.col(f"`{c}`") for c in df.columns])


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, words: int = 1) -> DataFrame:
    """The row with the smallest identifier of each component, with all columns of df.

    Exactly one row of each component stays, also where identifiers are null or repeat in other components.
    """
    return _first_of_each(df, _grouped(df, id_col, text_col, shingle, radius, words), id_col, text_col)


def similar_pairs(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, member whose label it has) of a forest over all pairs of sets whose Jaccard similarity is SIMILAR or
    more; empty sets are alike.

    First every set that has no leader yet is compared with all and leads those like it. A pair that is still in two
    components has a member outside the largest one, so comparing each such set with all leaves out no pair.
    """
    num, den = SIMILAR
    n = len(sets)
    size = np.array([len(x) for x in sets], dtype=np.int64)
    forest = Forest(n)
    empty = np.flatnonzero(size == 0)
    forest.link(empty[1:], empty[:-1])
    ends = np.cumsum(size)
    term = np.unique(np.concatenate(sets), return_inverse=True)[1]
    by_term = np.argsort(term, kind="stable")
    doc = np.repeat(np.arange(n), size)[by_term]
    start = np.concatenate([[0], np.cumsum(np.bincount(term))])

    def like(i: int) -> np.ndarray:
        t = term[ends[i] - size[i] : ends[i]]
        count = start[t + 1] - start[t]
        found = doc[np.repeat(start[t] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        if 8 * len(found) > n:
            common = np.bincount(found, minlength=n)
            found = np.flatnonzero(common)
            common = common[found]
        else:
            found, common = np.unique(found, return_counts=True)
        return found[common * (num + den) >= num * (size[i] + size[found])]

    def link(edges: list[tuple[int, np.ndarray]]) -> None:
        if edges:
            forest.link(np.repeat([i for i, _ in edges], [len(x) for _, x in edges]), np.concatenate([x for _, x in edges]))

    led, leads, edges = size == 0, size == 0, []
    for i in range(n):
        if not led[i]:
            leads[i] = True
            near = like(i)
            led[near] = True
            edges.append((i, near))
    link(edges)
    largest = np.bincount(forest.label).argmax()
    link([(i, like(i)) for i in np.flatnonzero(~leads & (forest.label != largest)).tolist()])
    linked = np.flatnonzero(forest.label != np.arange(n))
    return linked, forest.label[linked]


def _verified(batches):
    """Rows come sorted by unit (root, x, y); a unit is held in memory while its pairs are compared."""
    at, ids, sets = None, [], []

    def found():
        u, v = to_least(*similar_pairs(sets), np.array(ids, dtype=np.int64))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for b in batches:
        for *unit, i, grams in zip(*(b.column(c).to_pylist() for c in ("root", "x", "y", "text_hash", "grams")), strict=True):
            if unit != at:
                if len(ids) > 1:
                    yield found()
                at, ids, sets = unit, [], []
            ids.append(i)
            sets.append(np.frombuffer(grams, dtype=np.uint64))
    if len(ids) > 1:
        yield found()


def similar_edges(df: DataFrame, groups: DataFrame, text_col: str, shingle: int, most: int = SLICE) -> DataFrame:
    """Edges u, v between text hashes whose components are those of all pairs inside a root of groups (text_hash, root) that
    have a Jaccard similarity of SIMILAR or more, compared by the 64-bit hashes of all their shingles.

    A root with more than `most` shingles is dealt in slices, and every two slices meet in a unit of their own.
    """
    texts = groups.select("text_hash", "root").distinct()
    side = F.col("root").bitwiseXOR(F.lit(_SIDE))
    many = texts.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(side.alias("r"))
    open_ = texts.withColumn("r", side).join(many, "r").select(F.col("text_hash").alias("h"), "root")
    rows = df.select(F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).join(open_, F.col("text_hash") == F.col("h"))
    rows = rows.withColumn("again", F.row_number().over(Window.partitionBy("text_hash").orderBy(F.lit(0)))).where("again = 1").select("text_hash", "root", "text")

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(np.frombuffer(b"".join(shingle_digests(x, shingle)), dtype=np.uint64)) for x in bin_values(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("text_hash"), batch.column("root"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["text_hash", "root", "n", "grams"])

    rows = materialize(map_text(rows, "text", f, "text_hash long, root long, n long, grams binary"))
    hot = rows.groupBy("root").agg(F.sum("n").alias("s")).where(F.col("s") > most).select(F.col("root").alias("r"), F.ceil(F.col("s") / most).cast("int").alias("c"))
    # Roots of over `most` shingles are few; broadcast, they leave the sets of shingles where they are until the one deal below.
    hot = materialize(hot)
    rows = rows.join(F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot, F.col("root") == F.col("r"), "left").withColumn("c", F.coalesce("c", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("text_hash"), F.col("c")).cast("int"))
    rows = rows.select("root", "text_hash", "grams", "c", "own", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("other")).where("c = 1 OR own <> other")
    rows = rows.select("root", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "text_hash", "grams")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "root", "x", "y").sortWithinPartitions("root", "x", "y").mapInArrow(_verified, "u long, v long")


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """doc_id, text_hash, root for every row; a root is a component of texts whose word shingles have a Jaccard similarity of
    SIMILAR or more. Wide fingerprints only say which texts are compared: those of one component of their links."""
    near = materialize(_grouped(df, id_col, text_col, shingle, WIDE_RADIUS, WIDE).select("doc_id", "text_hash", "root"))
    linked = components(similar_edges(df, near, text_col, shingle)).withColumnRenamed("root", "least")
    both = near.join(linked, near["text_hash"] == linked["node"], "left")
    return both.select("doc_id", "text_hash", F.coalesce("least", "text_hash").alias("root"))


def keep_one_of_similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return _first_of_each(df, similar_groups(df, id_col, text_col), id_col, text_col)


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("w0")), 16, "0").alias("fingerprint"), "component_id")
