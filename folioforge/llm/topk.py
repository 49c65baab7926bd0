"""Exact top-k by inner product over a pivot-distance index.

Vectors are integers: floor(1024 x) of each component. A vector x of norm at most R is lifted to
(x, sqrt(R^2 - |x|^2)) and a query q to (q, 0); then |q' - x'|^2 = |q|^2 + R^2 - 2 q.x, so the largest inner
products are the smallest distances, and the triangle inequality over a pivot p,
|q' - x'| >= | |q' - p'| - |x' - p'| |, bounds a score from above.

Index. Pivots are PIVOTS vectors, farthest first, out of a sample of SAMPLE rows (the one bounded sample). Every
vector is keyed by its nearest pivot and its distance to it; the rows are range-sorted by that key into
parts of at most about PART_CELLS components, whatever one vector's or pivot's share, and written as a table. Within a part, stretches
of ANNULUS rows of a pivot are annuli with an inner and an outer radius.

Search. A query first searches the part with the best bound and gets a k-th score. It then visits only parts
whose bound reaches that score, and in each expands annuli from the best bound on, until no bound reaches
its k-th score so far. Bounds are compared with a slack for rounding and ties are visited, so results
are exact. Queries and parts meet by key, queries in blocks, and a part travels only to blocks with a query that asks for it; the
best k of each part are merged.

Defined results: rows with a null identifier, a null vector or a null or non-finite component take no part;
shorter vectors count as padded with zeros; a query skips all rows of its own identifier; repeated rows are
candidates each, repeated queries are answered once for each distinct vector; fewer than k candidates are
all returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, unit_hash

K = 10
SCALE = 1024
EVERY = 100
PIVOTS = 32
SAMPLE = 2000
ANNULUS = 256
QUERY_BLOCK = 8192
#: Components of the vectors that a part holds (32 MB as integers), whatever the input's size.
PART_CELLS = 1 << 22


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of long) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    return rows.select("vec_id", F.expr(f"transform(v, x -> cast(floor({scale}D * x) AS bigint))").alias("v"))


def _matrix(lists, width: int) -> np.ndarray:
    """Rows of integers, padded to a width."""
    out = np.zeros((len(lists), width), dtype=np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _arrow_matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)
    return _matrix(column.to_pylist(), width)


class Space:
    """Lifted geometry around the pivots."""

    def __init__(self, pivots: np.ndarray, radius2: float, width: int, exact: bool):
        self.width, self.radius2, self.exact = width, radius2, exact
        self.pivots = pivots.astype(np.float64)
        self.lift = np.sqrt(np.maximum(radius2 - (self.pivots**2).sum(axis=1), 0))
        self.square = (self.pivots**2).sum(axis=1)

    def far(self, x: np.ndarray, lifted: bool) -> np.ndarray:
        """Distances of vectors (lifted) or queries (not) to all pivots."""
        x = x.astype(np.float64)
        own = (x**2).sum(axis=1)
        up = np.sqrt(np.maximum(self.radius2 - own, 0)) if lifted else np.zeros(len(x))
        d2 = own[:, None] + self.square[None, :] - 2 * (x @ self.pivots.T) + (up[:, None] - self.lift[None, :]) ** 2
        return np.sqrt(np.maximum(d2, 0))

    def bound(self, q2: np.ndarray, to_pivot: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Largest score that a vector at a distance of lo to hi from the pivot can have, with slack."""
        gap = np.maximum(np.maximum(lo - to_pivot, to_pivot - hi), 0)
        slack = 1e-7 * (q2 + self.radius2 + 1)
        return (q2 + self.radius2 - gap**2) / 2 + slack

    def score(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Integer inner products: in doubles where all sums stay below 2^53, else in Python's integers."""
        if self.exact:
            return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        return (q.astype(object) @ x.astype(object).T).astype(np.int64)


def search(space: Space, pivot: np.ndarray, dist: np.ndarray, ids: np.ndarray, x: np.ndarray, qid: np.ndarray, q: np.ndarray, floor_: np.ndarray, k: int):
    """The best k of one part for each query, among scores of at least floor_: (query row, vec_id, score)."""
    cuts = np.flatnonzero(np.concatenate([[True], pivot[1:] != pivot[:-1]]))
    starts = np.concatenate([np.arange(a, b, ANNULUS) for a, b in zip(cuts, np.append(cuts[1:], len(pivot)), strict=True)])
    stops = np.append(starts[1:], len(pivot))
    lo, hi, at = dist[starts], dist[stops - 1], pivot[starts]
    q2 = (q.astype(np.float64) ** 2).sum(axis=1)
    low = -(1 << 62)
    rows, got_ids, got = [], [], []
    for s in range(0, len(q), 512):
        e = min(s + 512, len(q))
        bound = space.bound(q2[s:e, None], space.far(q[s:e], False)[:, at], lo[None, :], hi[None, :])
        best = np.full((e - s, k), low, dtype=np.int64)
        best_id = np.zeros((e - s, k), dtype=np.int64)
        kth = floor_[s:e].copy()
        for c in np.argsort(-bound.max(axis=0), kind="stable").tolist():
            live = np.flatnonzero(bound[:, c] >= kth)
            if not len(live):
                continue
            own = ids[starts[c] : stops[c]]
            score = space.score(q[s:e][live], x[starts[c] : stops[c]])
            score[own[None, :] == qid[s:e][live][:, None]] = low
            some = np.flatnonzero(score.max(axis=1) >= np.maximum(kth[live], low + 1))
            if not len(some):
                continue
            live, score = live[some], score[some]
            all_s = np.concatenate([best[live], score], axis=1)
            all_i = np.concatenate([best_id[live], np.broadcast_to(own, score.shape)], axis=1)
            order = np.lexsort((all_i, -all_s), axis=-1)[:, :k]
            best[live] = np.take_along_axis(all_s, order, axis=1)
            best_id[live] = np.take_along_axis(all_i, order, axis=1)
            kth[live] = np.maximum(kth[live], best[live][:, -1])
        r, c = np.nonzero((best > low) & (best >= floor_[s:e, None]))
        rows.append(r + s)
        got_ids.append(best_id[r, c])
        got.append(best[r, c])
    return np.concatenate(rows), np.concatenate(got_ids), np.concatenate(got)


def _visit(index: DataFrame, asked: DataFrame, space, k: int, blocks: int) -> DataFrame:
    """Searches each part for the queries that asked for it: query_id, qh, vec_id, score."""
    if blocks > 1:
        asked = materialize(asked)
        wanted = asked.groupBy(F.col("part").alias("_p")).agg(F.collect_set("block").alias("_b"))
        parts = index.join(wanted, F.col("part") == F.col("_p")).withColumn("block", F.explode("_b")).drop("_p", "_b")
    else:
        parts = index.withColumn("block", F.lit(0))

    def f(part: pa.Table, asks: pa.Table) -> pa.Table:
        if not part.num_rows or not asks.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "qh", "vec_id", "score")})
        sp = space.value
        part = part.sort_by([("pivot", "ascending"), ("dist", "ascending")])
        col = lambda t, c: t.column(c).to_numpy()
        row, ids, score = search(sp, col(part, "pivot"), col(part, "dist"), col(part, "vec_id"), _arrow_matrix(part.column("v"), sp.width),
                                 col(asks, "query_id"), _arrow_matrix(asks.column("v"), sp.width), col(asks, "floor"), k)
        return pa.table({"query_id": col(asks, "query_id")[row], "qh": col(asks, "qh")[row], "vec_id": ids, "score": score})

    schema = "query_id long, qh long, vec_id long, score long"
    return parts.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInArrow(f, schema)


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose id is divisible by `every`."""
    spark = df.sparkSession
    rows = integer_vectors(df, id_col, vec_col, scale)
    norm = "aggregate(v, 0D, (a, x) -> a + double(x) * double(x))"
    width, radius2, top, n_queries, total = rows.agg(F.max(F.size("v")), F.max(F.expr(norm)), F.max(F.expr("array_max(transform(v, x -> abs(x)))")), F.count_if(F.col("vec_id") % every == 0), F.count(F.lit(1))).first()
    empty = "query_id long, rank int, vec_id long, score long"
    if not n_queries:
        return spark.createDataFrame([], empty)
    width = max(width, 1)
    sample = _matrix([r["v"] for r in rows.orderBy(unit_hash(9, F.col("vec_id")), "vec_id", "v").limit(SAMPLE).collect()], width)
    chosen = [0]
    far = ((sample - sample[0]).astype(np.float64) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]).astype(np.float64) ** 2).sum(axis=1))
    space = spark.sparkContext.broadcast(Space(sample[chosen], float(radius2), width, width * float(top or 0) ** 2 < 2**53))  # PIVOTS vectors

    def key(batches):
        for b in batches:
            if b.num_rows:
                far = space.value.far(_arrow_matrix(b.column("v"), width), True)
                near = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(near), pa.array(far[np.arange(len(near)), near])], ["vec_id", "v", "pivot", "dist"])

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) * width // PART_CELLS))
    index = rows.mapInArrow(key, "vec_id long, v array<bigint>, pivot long, dist double").repartitionByRange(n, "pivot", "dist", "vec_id")
    index = materialize(index.withColumn("part", F.spark_partition_id()).sortWithinPartitions("pivot", "dist"))
    # One row a part, and one more wherever a pivot's rows begin inside a part: at most parts + PIVOTS rows of 32 bytes, a part being 32 MB.
    cells = index.groupBy("part", "pivot").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi")).toPandas().sort_values(["part", "pivot"])
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("qh"), "v").dropDuplicates(["query_id", "qh"])
    blocks = max(1, -(-int(n_queries) // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    part = cells["part"].to_numpy()
    group = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))

    def bounds(q: np.ndarray) -> np.ndarray:
        b = space.value.bound((q.astype(np.float64) ** 2).sum(axis=1)[:, None], space.value.far(q, False)[:, cells["pivot"].to_numpy()], cells["lo"].to_numpy()[None, :], cells["hi"].to_numpy()[None, :])
        return np.maximum.reduceat(b, group, axis=1)

    def ask(batches):
        """Round 1 (no floor yet): the part with the best bound. Round 2: every other part whose bound reaches the floor."""
        for b in batches:
            if not b.num_rows:
                continue
            best = bounds(_arrow_matrix(b.column("v"), width))
            home = best.argmax(axis=1)
            if "floor" in b.schema.names:
                low = b.column("floor").to_numpy(zero_copy_only=False)
                go = best >= low[:, None]
                go[np.arange(len(home)), home] = False
                r, c = np.nonzero(go)
            else:
                low = np.full(len(home), -(1 << 62))
                r, c = np.arange(len(home)), home
            pick = pa.array(r)
            yield pa.RecordBatch.from_arrays([*(b.column(x).take(pick) for x in ("query_id", "qh", "v")), pa.array(low[r]), pa.array(part[group][c].astype(np.int32))], ["query_id", "qh", "v", "floor", "part"])

    asked = "query_id long, qh long, v array<bigint>, floor long, part int"
    home = materialize(_visit(index, queries.mapInArrow(ask, asked).withColumn("block", block), space, k, blocks))
    floors = home.groupBy("query_id", "qh").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    more = queries.join(floors, ["query_id", "qh"], "left").withColumn("floor", F.coalesce("floor", F.lit(-(1 << 62))))
    rest = _visit(index, more.mapInArrow(ask, asked).withColumn("block", block), space, k, blocks)
    order = Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id")
    out = home.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op9_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
