"""Dictionary-compressed WARC archives (.warc.zst).

A file starts with a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary, itself a Zstandard
frame; every record follows as a frame of its own, compressed with it. The dictionary is built from the
file's own records: DICTIONARY bytes from the records whose lengths add up to SAMPLE bytes, taken evenly
over the first buffer of the file. It bears on size only: every record is written whole and read whole.

Of pages with equal payloads of at least MIN_REVISIT bytes the one with the smallest page_id is a response and
the others are revisits, which store headers and refer to it; smaller ones are all responses.

Equal payloads are found by SHA-1, length and a second 64-bit hash; the smallest page_id of a group is an
aggregate with partial sums and pages meet it in a join that Spark may split, so a payload of any share of
the rows is no single task's. Pages are dealt out by (page_id, digest) and move once.

Defined results: a very long html is one record; extra columns may have any name and are not written; a null html is empty; rows that repeat page_id and payload are one response and revisits to
it; null page_ids are responses unless a page with an identifier has the payload; an empty table gives no file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bin_values, materialize, shared_dir
from .files import Commit, open_input

MIN_REVISIT = 0
DICTIONARY = 64 << 10
SAMPLE = 4 << 20
LEVEL = 3
_MAGIC = 0x184D2A5D
_DATE = "1970-01-01T00:00:00Z"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP headers of its payload and not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {''.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{_digest(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The record's page_id, type, digest, payload length and the page it refers to; a response's payload is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or _digest(payload) != digest):
        raise ValueError("a payload differs from its digest")

    def number(name: str) -> int | None:
        x = fields.get(name, "")[len("<urn:page:") : -1]
        return int(x) if x else None

    return {"page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To")}


class ArchiveWriter:
    """Buffers the first records to build the dictionary from, then streams."""

    def __init__(self, out, level: int = LEVEL):
        self.out, self.level, self.first, self.held, self.zstd = out, level, [], 0, None

    def add(self, data: bytes) -> None:
        if self.zstd is None:
            self.first.append(data)
            self.held += len(data)
            if self.held >= 2 * SAMPLE:
                self._start()
        else:
            self.out.write(self.zstd.compress(data))

    def _start(self) -> None:
        step = max(1, self.held // SAMPLE)
        samples = self.first[::step]
        try:
            trained = zstandard.train_dictionary(min(DICTIONARY, max(1024, self.held // 8)), samples)
        except zstandard.ZstdError:  # too few records to train on: their beginning serves as a raw dictionary
            trained = zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packed = zstandard.ZstdCompressor(level=self.level).compress(trained.as_bytes())
        self.out.write(struct.pack("<II", _MAGIC, len(packed)) + packed)
        self.zstd = zstandard.ZstdCompressor(level=self.level, dict_data=trained, write_checksum=True)
        for x in self.first:
            self.out.write(self.zstd.compress(x))
        self.first = []

    def close(self) -> None:
        if self.zstd is None:
            self._start()


def read_archive(source):
    """Records of an archive, one after another."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != _MAGIC:
        raise ValueError("no dictionary frame")
    content = zstandard.ZstdDecompressor().decompress(source.read(size))
    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
    reader = zstandard.ZstdDecompressor(dict_data=trained)
    rest, engine, got = b"", reader.decompressobj(), io.BytesIO()
    while True:
        data = rest or source.read(1 << 18)
        if not data:
            return
        rest = b""
        got.write(engine.decompress(data))
        if engine.eof:
            yield got.getvalue()
            rest, engine, got = engine.unused_data, reader.decompressobj(), io.BytesIO()


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Writes the archives; a row a file."""
    page = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    page = page.withColumns({"d": F.unhex(F.sha1(F.col("html").cast("binary"))), "v": F.xxhash64("html"), "z": F.octet_length("html")})
    key = page.select("page_id", "d", "v", "z")
    first = key.where(F.col("z") >= min_revisit).groupBy("d", "v", "z").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("d").alias("fd"), F.col("v").alias("fv"), F.col("z").alias("fz"), "first")
    mine = key.select("page_id", "d", "v", "z").join(first, (F.col("d") == F.col("fd")) & (F.col("v") == F.col("fv")) & (F.col("z") == F.col("fz")))
    mine = mine.groupBy("page_id", "d", "v").agg(F.first("first").alias("first")).select(F.col("page_id").alias("mp"), F.col("d").alias("md"), F.col("v").alias("mv"), F.col("first"), F.lit(True).alias("many"))
    mine = mine.withColumn("mp", F.coalesce(F.col("mp").cast("string"), F.lit("")))
    # Pages are dealt out before the join, by its own keys, so the join moves only its narrow side.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    page = page.drop("z").withColumn("pk", F.coalesce(F.col("page_id").cast("string"), F.lit(""))).repartition(n, "pk", "d", "v")
    rows = page.join(mine, (F.col("pk") == F.col("mp")) & (F.col("d") == F.col("md")) & (F.col("v") == F.col("mv")), "left")
    rows = rows.select("page_id", "url", "html", "d", "v", "first", F.coalesce("many", F.lit(False)).alias("many")).sortWithinPartitions("page_id", "d", "v")

    def write(batches):
        from pyspark import TaskContext

        file = writer = last = None
        count = 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "d", "v", "first", "many")]
            for page_id, url, d, v, to, many, html in zip(*cols, bin_values(batch.column("html")), strict=True):
                if file is None:
                    file = Commit(folder, f"pages-{TaskContext.get().partitionId():06d}", ".warc.zst")
                    writer = ArchiveWriter(file)
                revisit = many and ((page_id, d, v) == last or page_id != to)
                last = (page_id, d, v)
                writer.add(record(page_id, url, html, to, revisit))
                count += 1
        if file is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"file": file.close(), "n_records": count}])

    return materialize(rows.mapInArrow(write, "file string, n_records long"))


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, from the archives."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with open_input(folder, name) as source:
                    for data in read_archive(source):
                        rows.append(parse(data))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = max(1, files.count())
    return files.repartition(n, "file").mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op10_warc(spark, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark)
    return read_archives(write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder), folder)


ORACLE = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(sha1(coalesce(html, '')), (k // 4) * 5 + 1, 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER g THEN min(page_id) OVER g END AS refers_to
FROM pages WINDOW g AS (PARTITION BY coalesce(html, ''))
"""
