"""Language identification by rank-order profiles.

A profile is the list of a language's PROFILE most frequent letter n-grams (one to three letters, words
padded by a boundary), ordered by frequency. A document's own PROFILE most frequent n-grams are compared
with each profile: the out-of-place distance adds up the differences in rank, PROFILE for an n-gram
that the profile lacks. The nearest profile names the language; score is one minus the distance as a
share of the largest possible one.

Profiles are learned from at most about TRAIN_DOCS documents a language, chosen by a seeded key of the
identifier, of the MOST_LANGS most frequent values of the language column; these are the documented bounds on the
training sample, and everything else reads all rows. They also bound what is broadcast.

Defined results: a very long text is profiled whole, in memory of a small multiple of its size; a null text, or one without a letter, is `und` with score 0, as is everything where
nothing could be learned; ties go to the language that sorts first; null identifiers count as held out;
rows that repeat are each predicted; extra columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, map_text, unit_hash, widened

PROFILE = 300
TRAIN_DOCS = 2000
MOST_LANGS = 1000
SEED = 7
SALTS = 8
UND = "und"
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point: its lower-case letter, or 0 if it is no letter."""
    if not _TABLE:
        table = np.zeros(0x110000, dtype=np.int64)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _TABLE.append(table)
    return _TABLE[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, packed 21 bits a letter, and their counts."""
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    c = np.concatenate([[0], c, [0]])
    is_letter = c > 0
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[0] = True
    c = c[keep]
    one = c[c > 0]
    if not len(one):
        return one, one
    two = (c[:-1] << 21) | c[1:]
    three = (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]
    three = three[c[1:-1] > 0]
    keys = np.concatenate([one, two, three])
    keys.sort()
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.diff(np.concatenate([at, [len(keys)]]))


def top_ranked(keys: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent keys, most frequent first, ties by key."""
    return keys[np.lexsort((keys, -counts))[:k]]


class Profiles:
    """Learned profiles: languages, all their n-grams, and each n-gram's rank by language."""

    def __init__(self, ranked: dict[str, list[int]], k: int = PROFILE):
        self.k = k
        self.langs = sorted(ranked)
        self.vocab = np.unique(np.array([x for v in ranked.values() for x in v], dtype=np.int64))
        self.rank = np.full((len(self.vocab), len(self.langs)), -1, dtype=np.int64)
        for j, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.vocab, np.array(ranked[lang], dtype=np.int64)), j] = np.arange(len(ranked[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UND, 0.0
        keys, counts = ngrams(text)
        if not len(keys):
            return UND, 0.0
        mine = top_ranked(keys, counts, self.k)
        at = np.searchsorted(self.vocab, mine)
        at[at == len(self.vocab)] = 0
        known = np.flatnonzero(self.vocab[at] == mine)
        theirs = self.rank[at[known]]
        apart = np.where(theirs < 0, self.k, np.abs(theirs - known[:, None]))
        total = apart.sum(axis=0) + self.k * (len(mine) - len(known))
        best = int(total.argmin())
        return self.langs[best], float(1.0 - total[best] / (self.k * len(mine)))


def held_out(id_col: str):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_docs: int = TRAIN_DOCS, k: int = PROFILE) -> Profiles:
    """Profiles from documents that are not held out and name a language."""
    rows = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where(~held_out("i") & F.col("l").isNotNull() & F.col("t").isNotNull())
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(MOST_LANGS).collect()}
    if not sizes:
        return Profiles({}, k)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, train_docs / n))])
    rows = rows.where(unit_hash(SEED, F.col("i")) < F.coalesce(F.try_element_at(share, F.col("l")), F.lit(0.0)) * float(1 << 60)).select("l", "t")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums: dict[str, dict[int, int]] = {}
        for lang, text in zip(batch.column("l").to_pylist(), batch.column("t").to_pylist(), strict=True):
            own = sums.setdefault(lang, {})
            for key, n in zip(*(x.tolist() for x in ngrams(text)), strict=True):
                own[key] = own.get(key, 0) + n
        flat = [(lang, key, n) for lang, own in sums.items() for key, n in own.items()]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.int64()), pa.array([x[2] for x in flat], pa.int64())], ["l", "g", "n"])

    counted = map_text(rows, "t", count, "l string, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("g")]
    salted = counted.withColumn("s", F.pmod(F.xxhash64("g"), F.lit(SALTS)))
    salted = salted.withColumn("r", F.row_number().over(Window.partitionBy("l", "s").orderBy(*order))).where(F.col("r") <= k)
    ranked: dict[str, list[tuple[int, int]]] = {}
    for r in salted.select("l", "g", "n").collect():  # at most SALTS * PROFILE rows a language
        ranked.setdefault(r["l"], []).append((-r["n"], r["g"]))
    return Profiles({lang: [g for _, g in sorted(v)[:k]] for lang, v in ranked.items()}, k)


def with_language(df: DataFrame, profiles: Profiles, text_col: str = "text", pred: str = "lang_pred", score: str = "score", drop_text: bool = False) -> DataFrame:
    """Adds the predicted language and its score to every row."""
    shared = df.sparkSession.sparkContext.broadcast(profiles)  # PROFILE ranks a language, whatever the input's size
    fields = [f for f in df.schema.fields if not (drop_text and f.name == text_col)]
    names = [f.name for f in fields]
    schema = widened(fields, **{pred: "string", score: "double"})

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [shared.value.predict(t) for t in batch.column(text_col).to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], [*names, pred, score])

    return map_text(df, text_col, f, schema)


def keep_identified(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """Rows whose language can be told; those without a letter go."""
    pred, score = free_name(df, "lang_pred", "score")
    return with_language(df, train(df, id_col, text_col, lang_col), text_col, pred, score).where(F.col(pred) != UND).select(*[F.col(f"`{c}`") for c in df.columns])


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = with_language(docs.select("doc_id", "text"), train(docs), drop_text=True)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
