"""Token files in a static range asymmetric numeral system (rANS).

Documents are laid out in ascending doc_id order over shards. A shard's ids fall into runs of a few million; a frequency
table counted over all ids of a run is stored with it and shared by its blocks. A block holds whole documents; its ids
are dealt over interleaved lanes, and all lanes take a coding step together in numpy. Each block carries its documents'
ids and lengths, checkpoints (lane states and word position every few hundred steps) from which parts of a block can be
decoded in parallel, and a checksum of its ids. Runs are rows of Parquet files, so Spark commits them, any store holds
them, and each is decoded without the others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, shared_path, stored
from .tokenize import WORD_BPE, Vocabulary, encoded

SCALE_BITS = 20
LANES = 1024
BLOCK_IDS = 1 << 18  # ids after which a block ends with the document
RUN_IDS = 1 << 23  # ids after which a run ends with the document
CHECK_STEPS = 64  # steps between two checkpoints
LOW = np.uint64(1 << 31)

BLOCK = pa.struct([("block", pa.int32()), ("n_ids", pa.int64()), ("steps", pa.int32()), ("doc_ids", pa.binary()),
                   ("doc_nulls", pa.binary()), ("lengths", pa.binary()), ("words", pa.binary()), ("states", pa.binary()),
                   ("places", pa.binary()), ("crc", pa.int64())])
RUN = ("shard int, run int, symbols binary, frequencies binary, blocks array<struct<block:int, n_ids:long, steps:int, "
       "doc_ids:binary, doc_nulls:binary, lengths:binary, words:binary, states:binary, places:binary, crc:long>>")


def frequencies(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to a sum of ``2**bits``; what occurs keeps at least 1, what doesn't has 0."""
    there, total = counts > 0, 1 << bits
    f = there + np.floor(counts / max(1, counts.sum()) * (total - there.sum())).astype(np.int64)
    f[np.argmax(f)] += total - f.sum()
    return f


class Coder:
    """Interleaved rANS over ``lanes`` with 64-bit states that give off 32-bit words."""

    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS, lanes: int = LANES, every: int = CHECK_STEPS):
        self.bits, self.lanes, self.every = np.uint64(bits), lanes, every
        self.f = freq.astype(np.uint64)
        self.c = (np.cumsum(freq) - freq).astype(np.uint64)
        self.limit = self.f << np.uint64(63 - bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)  # by slot

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """``(words, states, places, steps)``: words in the order they are read; at each checkpoint, the lanes'
        states and the number of words read before it."""
        steps = -(-len(ids) // self.lanes)
        grid = np.full(steps * self.lanes, ids[0] if len(ids) else 0, np.int64)  # filled up with an id that has a frequency
        grid[:len(ids)] = ids
        grid = grid.reshape(steps, self.lanes)
        x = np.full(self.lanes, LOW, np.uint64)
        given, states, left = [], [], []
        total = 0
        for t in range(steps - 1, -1, -1):
            s = grid[t]
            f = self.f[s]
            over = x >= self.limit[s]
            if over.any():
                given.append((x[over] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                total += len(given[-1])
                x = np.where(over, x >> np.uint64(32), x)
            q, r = np.divmod(x, f)
            x = (q << self.bits) + r + self.c[s]
            if t % self.every == 0:
                states.append(x.copy())
                left.append(total)
        words = np.concatenate(given[::-1]) if given else np.zeros(0, "<u4")
        return (words, np.asarray(states[::-1], "<u8").reshape(-1, self.lanes),
                total - np.asarray(left[::-1], "<i8"), steps)

    def decode(self, words: np.ndarray, states: np.ndarray, places: np.ndarray, steps: int, first: int = 0,
               checkpoints: int | None = None) -> np.ndarray:
        """The ids from checkpoint ``first`` on, of all or so many checkpoints' steps; none of the rest is read."""
        last = len(states) if checkpoints is None else min(len(states), first + checkpoints)
        begin, end = first * self.every, min(steps, last * self.every)
        if begin >= end:
            return np.zeros(0, np.int64)
        x, at = states[first].astype(np.uint64), int(places[first])
        out = np.empty((end - begin, self.lanes), np.int64)
        for t in range(begin, end):
            slot = x & self.mask
            s = self.symbol[slot]
            out[t - begin] = s
            x = self.f[s] * (x >> self.bits) + slot - self.c[s]
            under = x < LOW
            n = int(np.count_nonzero(under))
            if n:
                x[under] = (x[under] << np.uint64(32)) | words[at:at + n].astype(np.uint64)
                at += n
        return out.reshape(-1)


def encode_run(coder: Coder, first_block: int, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray,
               ids: np.ndarray) -> list[dict]:
    """The blocks of a run: each ends with the document that fills it."""
    ends, blocks, begin = np.cumsum(lengths), [], 0
    while begin < len(lengths):
        base = int(ends[begin - 1]) if begin else 0
        end = min(len(lengths), int(np.searchsorted(ends, base + BLOCK_IDS, "left")) + 1)
        part = ids[base:int(ends[end - 1])]
        words, states, places, steps = coder.encode(part)
        blocks.append({
            "block": first_block + len(blocks), "n_ids": len(part), "steps": steps,
            "doc_ids": doc_ids[begin:end].astype("<i8").tobytes(), "doc_nulls": np.packbits(nulls[begin:end]).tobytes(),
            "lengths": lengths[begin:end].astype("<i8").tobytes(), "words": words.tobytes(), "states": states.tobytes(),
            "places": places.tobytes(), "crc": zlib.crc32(part.astype("<u4").tobytes())})
        begin = end
    return blocks


def decode_block(coder: Coder, block: dict) -> np.ndarray:
    """A block's ids, as little-endian unsigned 32-bit integers; raises where they don't match the checksum."""
    states = np.frombuffer(block["states"], "<u8").reshape(-1, coder.lanes)
    ids = coder.decode(np.frombuffer(block["words"], "<u4"), states, np.frombuffer(block["places"], "<i8"), block["steps"])
    ids = ids[:block["n_ids"]].astype("<u4")
    if zlib.crc32(ids.tobytes()) != block["crc"]:
        raise ValueError(f"block {block['block']} is damaged")
    return ids


def run_coder(symbols: bytes, freq: bytes) -> Coder:
    at = np.frombuffer(symbols, "<u4")
    table = np.zeros(int(at.max()) + 1 if len(at) else 1, np.int64)
    table[at] = np.frombuffer(freq, "<u4")
    return Coder(table)


def write_ids(docs: DataFrame, path: str, vocabulary: Vocabulary, end_id: int, shards: int) -> None:
    """Encodes ``docs`` (doc_id, text) into run rows under ``path``, in ascending doc_id order over the shards. A task
    holds one run's ids."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, run, block = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []  # (doc ids, nulls, lengths, ids)
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, run, block
            doc_ids, nulls, lengths, ids = (np.concatenate(c) for c in zip(*held))
            freq = frequencies(np.bincount(ids))
            blocks = encode_run(Coder(freq), block, doc_ids, nulls, lengths, ids)
            at = np.flatnonzero(freq)
            row = [pa.array([shard], pa.int32()), pa.array([run], pa.int32()), pa.array([at.astype("<u4").tobytes()], pa.binary()),
                   pa.array([freq[at].astype("<u4").tobytes()], pa.binary()), pa.array([blocks], pa.list_(BLOCK))]
            held, size, run, block = [], 0, run + 1, block + len(blocks)
            return pa.RecordBatch.from_arrays(row, ["shard", "run", "symbols", "frequencies", "blocks"])

        for rows, ids, ends in encoded(batches, vocabulary):
            n = np.diff(ends, prepend=0) + 1
            ids = np.insert(ids.astype(np.uint32), ends, end_id)
            keys = rows.column("doc_id")
            held.append((keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False), n, ids))
            size += len(ids)
            if size >= RUN_IDS:
                yield flush()
        if held:
            yield flush()

    # Rows of one id go on by a hash of their text and a row number, so that a hot id fills several shards.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"),
                        F.monotonically_increasing_id().alias("_n"))
    order = [F.col("doc_id").asc_nulls_first(), "_hash", "_n"]
    (keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(write, RUN).write.parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Decodes run rows: per document shard, block, place, doc_id, n_tokens, ids (binary, little-endian unsigned
    32-bit). A block whose ids don't match its checksum raises."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                run = batch.slice(k, 1).to_pylist()[0]
                coder = run_coder(run["symbols"], run["frequencies"])
                for b in run["blocks"]:
                    raw = decode_block(coder, b).tobytes()
                    lengths = np.frombuffer(b["lengths"], "<i8")
                    nulls = np.unpackbits(np.frombuffer(b["doc_nulls"], np.uint8), count=len(lengths)).astype(bool)
                    ends = (np.cumsum(lengths) * 4).tolist()
                    parts = [raw[m:n] for m, n in zip([0, *ends[:-1]], ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([run["shard"]] * len(parts), pa.int32()), pa.array([b["block"]] * len(parts), pa.int32()),
                         pa.array(range(len(parts)), pa.int32()),
                         pa.array(np.frombuffer(b["doc_ids"], "<i8"), pa.int64(), mask=nulls),
                         pa.array(lengths, pa.int64()), pa.array(parts, pa.binary())],
                        ["shard", "block", "place", "doc_id", "n_tokens", "ids"])

    return spark.read.parquet(path).mapInArrow(
        read, "shard int, block int, place int, doc_id long, n_tokens long, ids binary")


def encode_documents(docs: DataFrame, vocabulary: Vocabulary = WORD_BPE, end_id: int = 1, shard_bytes: int = 32 << 20) -> str:
    """Writes all ``docs`` (doc_id, text) as rANS token files in ascending doc_id order; returns their folder.

    Null texts are empty ones (the end id alone), null doc_ids come first, rows with one doc_id are ordered by a hash
    of their text and dealt over shards like others, other columns are left out, an empty table gives files without runs."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    path = shared_path(spark, "ids")
    write_ids(docs, path, vocabulary, end_id, max(1, -(-total // shard_bytes)))
    return path


def document_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before, to rows with shard, block, place, n_tokens.

    Sums in three levels (shards, a shard's blocks, a block's documents); only the first runs in one task, over
    one row per shard."""
    from pyspark.sql import Window

    upto = Window.unboundedPreceding
    blocks = rows.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    first = shards.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(upto, -1)), F.lit(0)).alias("shard_start"))
    blocks = blocks.select("shard", "block", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("block").rowsBetween(upto, -1)), F.lit(0)).alias("block_start"))
    inside = F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("shard", "block").orderBy("place").rowsBetween(upto, -1)), F.lit(0))
    return rows.withColumn("inside", inside).join(blocks.join(first, "shard"), ["shard", "block"]).withColumn(
        "start", (F.col("shard_start") + F.col("block_start") + F.col("inside")).cast("long")).drop(
        "inside", "shard_start", "block_start")


def op7_token_ans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = encode_documents(documents(spark, sf_dir, "doc_id", "text"))
    rows = read_ids(spark, path).select(
        "shard", "block", "place", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    rows = stored(spark, rows, "read")  # the sums below read it several times
    return document_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
