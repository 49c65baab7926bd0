"""Best-fit packing of token sequences, bulk-synchronously.

Documents are token ids plus an end id. Only those longer than a sequence are cut, into full pieces and
one last piece. Pieces are packed by best fit, longest first, in supersteps:

* documents are range-sorted by length and gaps by size, both as runs (a length and an interval of ranks; a
  gap size and an interval of sequences). Lengths are integers up to the sequence length, so runs number at
  most a few thousand whatever the input's size;
* a superstep takes all documents of the longest open length and sweeps to the successor gap size, the
  smallest one that still holds that length; the documents' ranks resolve the conflict over which takes which
  slot (rank r takes the r-th slot of the sweep), the rest sweep on to the next gap size, and what no gap
  holds opens new sequences;
* the gaps' sizes are updated and the next superstep begins.

What is distributed: reading, tokenizing, counting lengths, ranking documents inside their length (by
buckets of a key, so that a length of any share of the rows is never one task's), and placing each
document by its length and rank in the sweep's runs. The run table, bounded by the sequence length alone, is
all that the driver holds.

Defined results: a very long text is cut like any other that exceeds a sequence; ties between documents of one length go by a
seeded hash of identifier, piece and ids; columns of the input other than the identifier and the text play no
part and may have any name; a null text is empty, so its only id is the end id; rows that repeat are each packed; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bin_values, map_text, materialize, unit_hash
from .shard import CELLS, ROWS_A_BUCKET, _before
from .tokens import default_path, word_ids

LENGTH = 2048
END_ID = 0


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    path = path or default_path()

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, ends = word_ids(path).encode(bin_values(batch.column("text")), end_id)
        rows: list[tuple] = []
        begin = 0
        for i, end in enumerate(ends.tolist()):
            for k, at in enumerate(range(begin, end, length)):
                own = flat[at : min(end, at + length)]
                rows.append((i, k, at - begin, len(own), zlib.crc32(own.astype("<u4", copy=False))))
            begin = end
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
            *(pa.array(c, pa.int64()) for c in cols[2:]),
        ], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_text(rows, "text", f, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_runs(counts: dict[int, int], length: int = LENGTH) -> np.ndarray:
    """Supersteps over runs. Rows: length, first rank, copies in a sequence, first sequence, offset of the first copy."""
    gaps: dict[int, list[list[int]]] = {}  # gap size -> [first sequence, how many]
    sizes: list[int] = []
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def add(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in gaps:
                gaps[size] = []
                insort(sizes, size)
            runs = gaps[size]
            if runs and runs[-1][0] + runs[-1][1] == first:
                runs[-1][1] += n
            else:
                runs.append([first, n])

    for own in sorted(counts, reverse=True):
        left, rank = counts[own], 0
        found: list[tuple[int, int, int]] = []
        at = bisect_left(sizes, own)
        while left and at < len(sizes):  # the sweep: successor gap sizes, smallest first
            size = sizes[at]
            fits, runs = size // own, gaps[size]
            while left and runs:
                first, n = runs[-1]
                full = min(n, left // fits)
                if full:
                    out.append((own, rank, fits, first, length - size))
                    found.append((size - fits * own, first, full))
                    rank, left = rank + full * fits, left - full * fits
                    runs[-1] = [first + full, n - full]
                elif left:
                    out.append((own, rank, left, first, length - size))
                    found.append((size - left * own, first, 1))
                    rank, left = rank + left, 0
                    runs[-1] = [first + 1, n - 1]
                if not runs[-1][1]:
                    runs.pop()
            if runs:
                at += 1
            else:
                del gaps[size]
                sizes.pop(at)
        if left:
            fits = length // own
            full, rest = divmod(left, fits)
            if full:
                out.append((own, rank, fits, opened, 0))
                found.append((length - fits * own, opened, full))
            if rest:
                out.append((own, rank + full * fits, rest, opened + full, 0))
                found.append((length - rest * own, opened + full, 1))
            opened += full + (rest > 0)
        for size, first, n in found:
            add(size, first, n)
    return np.array(out, dtype=np.int64).reshape(-1, 5)


def _ranked(rows: DataFrame, total: int) -> DataFrame:
    """Adds rank, from 0 inside each length."""
    cells = max(1, min(CELLS, -(-total // ROWS_A_BUCKET)))
    rows = rows.withColumn("_k", unit_hash(3, F.col("doc_id"), F.col("piece"), F.col("ids_crc32")))
    rows = rows.withColumn("_b", F.expr(f"shiftright(_k, 44) * {cells}L div 65536L"))
    counts = rows.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy("length", "_b").orderBy("_k", "doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("_r", F.row_number().over(inside)).join(_before(counts, ["length"], "_b", "_n", "_o"), ["length", "_b"])
    return rows.withColumn("rank", F.col("_o") + F.col("_r") - 1).drop("_k", "_b", "_r", "_o")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    rows = materialize(pieces(df, id_col, text_col, length, end_id, path))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `length` rows
    runs = best_fit_runs(counts, length)
    shared = df.sparkSession.sparkContext.broadcast(runs[np.lexsort((runs[:, 1], runs[:, 0]))])

    def place(batches):
        table = shared.value
        # Ranks stay below 2^44 rows a length, so a length and a rank fit one 64-bit key.
        key = (table[:, 0] << 44) | table[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            own, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            run = table[np.searchsorted(key, (own << 44) | rank, side="right") - 1]
            i = rank - run[:, 1]
            where = [pa.array(run[:, 3] + i // run[:, 2]), pa.array(run[:, 4] + i % run[:, 2] * own)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *where], [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return _ranked(rows, sum(counts.values())).mapInArrow(place, schema)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
