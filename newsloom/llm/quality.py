"""Quality classifier: a factorisation machine over hashed words, structure statistics.

A text's features are its hashed lower-cased words (log counts, scaled to unit length) and a few dense statistics of
its characters, lines and words. The machine adds a low-rank interaction of every pair of features, computed in
linear time as half of (sum of v x)^2 - sum of (v x)^2. It is fitted on a bounded sample of labelled rows and scores
every whole text where it lies. Metadata takes no part: lang, source and doc_id are forbidden as inputs, and n_chars is
the text's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

BUCKETS = 1 << 14
RANK = 8
SAMPLE_ROWS = 3_000  # labelled rows that the machine is fitted on, at most
EPOCHS = 10
DENSE = 16
FEATURES = "doc_id long, quality int, at binary, value binary, dense binary"

_HASHES: dict[bytes, int] = {}
_KEEP = 150_000
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _bucket(word: bytes) -> int:
    """A word's bucket; a word's edge marks (one trailing and one leading run of marks) are words of their own."""
    if (k := _HASHES.get(word)) is None:
        if len(_HASHES) > _KEEP:
            _HASHES.clear()
        k = _HASHES[word] = xxhash.xxh32_intdigest(word) % BUCKETS
    return k


_MARKS = re.compile(rb"[!-/:-@\[-`{-~]+")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, values, dense)`` of a whole text; empty and null texts have no words."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.lower().split()
    marks = _MARKS.findall(raw)
    n, m = len(words), max(1, len(words))
    codes = [_bucket(w) for w in words] + [_bucket(b"\x00" + w) for w in marks]
    counts = np.bincount(np.array(codes, np.int64), minlength=1) if codes else np.zeros(0, np.int64)
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at])
    norm = np.sqrt((value ** 2).sum())
    data = np.frombuffer(raw, np.uint8)
    size = max(1, len(data))
    lines = raw.split(b"\n")
    line_n = len(lines)
    upper = np.count_nonzero((data >= 65) & (data <= 90))
    lower = np.count_nonzero((data >= 97) & (data <= 122))
    digits = np.count_nonzero((data >= 48) & (data <= 57))
    space = np.count_nonzero((data == 32) | ((data >= 9) & (data <= 13)))
    dense = np.array([
        np.log1p(len(data)) / 10, np.log1p(n) / 8, len(data) / m / 10 if n else 0, n and len(set(words)) / m,
        upper / size * 4, digits / size * 8, np.count_nonzero(_PUNCTUATION[data]) / size * 8, space / size * 4,
        np.count_nonzero(data >= 128) / size * 4, (1 - len(set(lines)) / line_n) * 2, np.log1p(line_n) / 5,
        sum(map(len, marks)) / max(1, len(marks)) / 3, len(marks) / m, max(map(len, words), default=0) / 50 if n < 1e9 else 0,
        upper / max(1, upper + lower) * 2, max((counts.max() / m, 0)) if n else 0], np.float32)
    return at.astype(np.int32), (value / norm if norm else value).astype(np.float32), np.minimum(dense, 4)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # buckets + dense
    factors: np.ndarray  # (buckets + dense) x rank

    def raw(self, at: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[at] * value[:, None]
        pairs = 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum())
        return float(self.bias + self.weights[at] @ value + pairs)

    def score(self, text: str | None) -> float:
        at, value, dense = features(text)
        x = np.concatenate([value, dense])
        return 1 / (1 + np.exp(-np.clip(self.raw(np.concatenate([at, BUCKETS + np.arange(DENSE)]), x), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], rank: int = RANK, epochs: int = EPOCHS,
        rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss, both classes weighing alike. Without rows of both classes the machine knows
    only their share."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + DENSE
    w, v, b = np.zeros(size), rng.normal(0, 0.02, (size, rank)), 0.0
    labels = np.array([r[3] for r in rows])
    good = int(labels.sum())
    if not len(rows) or good in (0, len(rows)):
        return Machine(np.log((good + 1) / (len(rows) - good + 1)), w, v * 0)
    gain = {1: len(rows) / 2 / good, 0: len(rows) / 2 / (len(rows) - good)}
    gw, gv, gb = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    dense_at = BUCKETS + np.arange(DENSE)
    data = [(np.concatenate([at, dense_at]), np.concatenate([value, dense]).astype(np.float64), y) for at, value, dense, y in rows]
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            at, x, y = data[k]
            va = v[at]
            vx = va * x[:, None]
            s = vx.sum(0)
            z = b + w[at] @ x + 0.5 * ((s ** 2).sum() - (vx ** 2).sum())
            g = gain[y] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
            gb += g * g
            b -= rate * g / np.sqrt(gb)
            d = g * x + decay * w[at]
            gw[at] += d * d
            w[at] -= rate * d / np.sqrt(gw[at])
            d = g * (x[:, None] * s - va * (x ** 2)[:, None]) + decay * va
            gv[at] += d * d
            v[at] -= rate * d / np.sqrt(gv[at])
    return Machine(float(b), w, v)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(3)) == 1


def taught(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """The feature rows that ``train`` fits on, one per document and label: FEATURES."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64("doc_id", F.lit(17))
    half = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(sample_rows // 2) for q in (0, 1)]
    sample = stored(docs.sparkSession, half[0].unionByName(half[1]), "sample")

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"),
                 *[pa.array([f[k].tobytes() for f in found], pa.binary()) for k in range(3)]],
                ["doc_id", "quality", "at", "value", "dense"])

    # At most sample_rows small rows are broadcast; the rows of a document are reduced to one, on the map side first, so
    # as many feature rows at most meet in the one task that fits the machine.
    seen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").mapInArrow(
        see, FEATURES)
    parts = ["at", "value", "dense"]
    return seen.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64(*parts), *parts)).alias("m")).select(
        "doc_id", "quality", *[f"m.{c}" for c in parts])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fits the machine on at most ``sample_rows`` labelled, not held-out rows: those with the least hashes of their
    id, half of them of each label. Rows with null ids or labels, or labels without a document, teach nothing; of a
    document with several labels each counts, equal label rows once. Of a repeated doc_id with different texts, the one
    with the least hash teaches."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["at"], r["value"], r["dense"]))
        m = fit([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"], np.float32),
                  np.frombuffer(r["dense"], np.float32), r["quality"]) for r in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.bias], pa.float64()), pa.array([m.weights.tobytes()], pa.binary()),
             pa.array([m.factors.tobytes()], pa.binary())], ["bias", "weights", "factors"])

    found = taught(docs, labels, sample_rows).repartition(1).mapInArrow(learn, "bias double, weights binary, factors binary").collect()
    if not found:
        return fit([])
    factors = np.frombuffer(found[0]["factors"])
    return Machine(found[0]["bias"], np.frombuffer(found[0]["weights"]), factors.reshape(-1, RANK))


def score(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score in 0 to 1 of each whole text; null and empty texts are scored as texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # buckets x (rank + 1) doubles

    @F.pandas_udf("double")
    def apply(texts):
        import pandas as pd
        own = shared.value
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    return docs.withColumn(out, apply(F.col(text)))


def op6_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, machine).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
