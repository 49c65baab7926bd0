"""Pieces that the operators of this subpackage share: shared-folder tables, Arrow text access, ranks."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_OWN_DIR: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Only where that setting is unset and the session is local, as in tests, is a temporary folder made; on a cluster a
    missing setting is an error. The folder goes when the session's JVM ends.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _OWN_DIR:
            _OWN_DIR.append("file://" + tempfile.mkdtemp(prefix="folioforge-"))
        base = _OWN_DIR[0]
    path = f"{base.rstrip('/')}/folioforge-{uuid.uuid4().hex}"
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(gone)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows as Parquet in the shared folder and read them again.

    The written table survives lost executors, and what follows never recomputes what went before.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that do not clash with those of df (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        x = name
        while x.lower() in taken:
            x = "_" + x
        taken.add(x.lower())
        out.append(x)
    return out


class Grown:
    """An array that grows by half at least."""

    def __init__(self, kind):
        self.store, self.n = np.zeros(1 << 12, dtype=kind), 0

    def add(self, x: np.ndarray) -> None:
        n = self.n + len(x)
        if n > len(self.store):
            self.store = np.concatenate([self.store[: self.n], np.zeros(max(n, 3 * len(self.store) // 2) - self.n, dtype=self.store.dtype)])
        self.store[self.n : n] = x
        self.n = n

    @property
    def all(self) -> np.ndarray:
        return self.store[: self.n]


def bin_values(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else pa.binary()
    return col.cast(kind).to_pylist() if col.type != kind else col.to_pylist()


#: Bytes of text that one Arrow batch and one step of numpy work hold.
BATCH_BYTES = 2 << 20


def _give_back() -> None:
    """Free memory that a worker holds after a task, for the next operator's tasks run in the same worker."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def sliced(batch: pa.RecordBatch, text: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text, so that numpy work stays in bounded memory."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.array([len(x) if x else 0 for x in bin_values(batch.column(text))], dtype=np.int64)
    part = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, n], strict=True):
        yield batch.slice(a, b - a)


def widened(fields: list, **more: str) -> StructType:
    """A schema of fields and further columns by type name; field names may hold any character."""
    out = StructType(list(fields))
    for name, kind in more.items():
        out = out.add(name, kind)
    return out


def map_text(df: DataFrame, text: str, f: Callable, schema: str | StructType) -> DataFrame:
    """mapInArrow over parts of bounded text size; f(batch) -> RecordBatch.

    The result is lazy, so the size of Arrow batches is set on the session and stays set.
    """

    def run(batches):
        for batch in batches:
            for part in sliced(batch, text):
                yield f(part)
        _give_back()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * BATCH_BYTES))
    return df.mapInArrow(run, schema)


def unit_hash(seed: int, *cols: Column) -> Column:
    """A seeded 60-bit non-negative shuffle key that any SQL engine can restate: the first 15 hex digits of an MD5."""
    parts = [F.coalesce(c.cast("string"), F.lit("~")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
