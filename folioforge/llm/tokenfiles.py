"""Token ids in seekable Zstandard files.

A file is a run of independent Zstandard frames and, at its end, a seek table in a skippable frame (magic
0x184D2A5E): for each frame its compressed size, its decompressed size and a checksum (the low 32 bits of
the decompressed content's XXH64), then the number of frames, a descriptor byte and the magic 0x8F92EAB1.
Every document is one frame of little-endian 32-bit ids, so a reader decompresses the documents it wants
and no other; the last frame is the index (doc_ids and the ids before each document in this file).

Documents are range-partitioned by doc_id; a partition is a file. A manifest (file, order, ids before it)
gives the start of each document in the whole. Files are written once, in the shared folder, and named by the
rows that their tasks return; the manifest is a written table, so a lost executor repeats no tokenizing.

Defined results: a very long text is one long frame; extra columns may have any name and are not written; a null text is empty; null doc_ids come first; rows that repeat a doc_id follow each other in
the order of their text's hash; an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bin_values, materialize, shared_dir, sliced
from .files import Commit, open_input
from .tokens import default_path, word_ids

END_ID = 2
LEVEL = 3
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_CHECKED = 0x80
_NULL = -(1 << 63)


class SeekableWriter:
    def __init__(self, out, level: int = LEVEL):
        self.out, self.zstd, self.table = out, zstandard.ZstdCompressor(level=level), []

    def frame(self, data: bytes) -> None:
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        body = np.array(self.table, dtype="<u4").tobytes() + struct.pack("<IBI", len(self.table), _CHECKED, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)


class SeekableReader:
    def __init__(self, source):
        self.source = source
        end = source.size()
        source.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != _SEEKABLE:
            raise ValueError("no seek table")
        width = 12 if flags & _CHECKED else 8
        source.seek(end - 9 - n * width)
        table = np.frombuffer(source.read(n * width), dtype="<u4").reshape(n, width // 4)
        self.size, self.plain = table[:, 0].astype(np.int64), table[:, 1]
        self.check = table[:, 2] if width == 12 else None
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        self.source.seek(int(self.at[i]))
        data = self.zstd.decompress(self.source.read(int(self.size[i])), max_output_size=int(self.plain[i]) or 1)
        if self.check is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.check[i]:
            raise ValueError(f"frame {i} is damaged")
        return data

    def index(self) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and the ids before each document in this file."""
        flat = np.frombuffer(self.frame(len(self.size) - 1), dtype="<i8").reshape(2, -1)
        return flat[0], flat[1]

    def document(self, doc_id: int) -> np.ndarray:
        ids = self.index()[0]
        at = int(np.searchsorted(ids, doc_id))
        if at == len(ids) or ids[at] != doc_id:
            raise KeyError(doc_id)
        return np.frombuffer(self.frame(at), dtype="<u4")


def write_token_files(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Writes the files; a row a file: ordinal, file, n_docs, n_ids, base (ids in earlier files)."""
    path = path or default_path()
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h").drop("h")

    def write(batches):
        from pyspark import TaskContext

        ordinal = TaskContext.get().partitionId()
        file = writer = None
        ids, starts, total = [], [], 0
        for batch in batches:
            for part in sliced(batch, "text"):
                if file is None:
                    file = Commit(folder, f"tokens-{ordinal:06d}", ".zst")
                    writer = SeekableWriter(file)
                flat, ends = word_ids(path).encode(bin_values(part.column("text")), end_id)
                begin = 0
                for doc_id, end in zip(part.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                    writer.frame(flat[begin:end].astype("<u4", copy=False).tobytes())
                    ids.append(_NULL if doc_id is None else doc_id)
                    starts.append(total)
                    total += end - begin
                    begin = end
        if file is not None:
            writer.frame(np.array([ids, starts], dtype="<i8").tobytes())
            writer.close()
            yield pa.RecordBatch.from_pylist([{"ordinal": ordinal, "file": file.close(), "n_docs": len(ids), "n_ids": total}])

    manifest = materialize(rows.mapInArrow(write, "ordinal long, file string, n_docs long, n_ids long"))
    before = Window.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_input(folder, row["file"]) as source:
                    reader = SeekableReader(source)
                    ids, starts = reader.index()
                    n, crc = [], []
                    for i in range(len(ids)):
                        data = reader.frame(i)
                        n.append(len(data) // 4)
                        crc.append(zlib.crc32(data))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids, mask=ids == _NULL), pa.array(starts + row["base"]), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                    ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return manifest.repartition(n, "ordinal").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark)
    return read_token_files(write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder), folder)
