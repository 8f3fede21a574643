"""Best-fit packing with certified bin counts.

Every document becomes its token ids plus an end id; longer ones are cut into full sequences with a shorter first
piece. Pieces of a full sequence stand alone. The rest is dealt into groups by hash; each group is packed by best-fit
decreasing, and dual-feasible functions give a lower bound of its bin count. A group that meets its bound is
certified and done. A group with a gap gives the pieces of its unfilled bins into an exchange: they are dealt anew
into fewer groups and packed again, as long as that saves bins.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored
from .tokenize import BYTE_BPE, Vocabulary, encoded

GROUP_PIECES = 16_384  # pieces packed in one task, about
ROUNDS = 6
ORDER_BITS = 13  # places of one group along an order
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int, vocabulary: Vocabulary, end_id: int, doc_id: str = "doc_id",
           text: str = "text", order: str | None = None) -> DataFrame:
    """``docs`` -> one row per piece: doc_id, piece, start, length, ids_crc32, at (the document's ``order``). A null text
    is an empty one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, ends in encoded(batches, vocabulary):
            flat = memoryview(np.insert(ids, ends, end_id).astype("<u4")).cast("B")
            sizes = np.diff(ends, prepend=0) + 1
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            first = ((sizes - 1) % capacity + 1)[row]
            start = np.where(piece > 0, first + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first)
            begin = 4 * ((np.cumsum(sizes) - sizes)[row] + start)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), rows.column("at").take(pa.array(row))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "at"])

    place = F.lit(None) if order is None else F.col(order)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), place.cast("long").alias("at")).mapInArrow(
        cut, f"{PIECE}, at long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best over the dual-feasible functions that count a length over
    ``capacity - t`` as a whole bin and one under ``t`` as nothing (t = 0: the plain sum of lengths)."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[:capacity + 1].astype(np.int64)
    number, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    t = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - t + 1]
    middle = total[capacity - t + 1] - total[t]
    return int((large + -(-middle // capacity)).max())


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bin, offset)`` of every length, and each bin's fill. The longest goes first, into the fullest bin that
    takes it."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets, fills = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    rooms: list[int] = []  # free spaces that some bin has, ascending
    open_bins: dict[int, list[int]] = {}
    for k, length in zip(order.tolist(), lengths[order].tolist()):
        at = bisect_left(rooms, length)
        if at == len(rooms):
            b, room = len(fills), capacity
            fills.append(0)
        else:
            room = rooms[at]
            b = open_bins[room].pop()
            if not open_bins[room]:
                del rooms[at]
        bins[k], offsets[k] = b, fills[b]
        fills[b] += length
        if (left := room - length) > 0:
            if not open_bins.get(left):
                insort(rooms, left)
                open_bins[left] = []
            open_bins[left].append(b)
    return bins, offsets, np.asarray(fills, np.int64)


def _hashed(items: DataFrame, groups: int, salt: int) -> DataFrame:
    return items.withColumn("group", F.pmod(
        F.xxhash64(F.lit(salt), "doc_id", "piece", "ids_crc32", "start", F.col("copy")), F.lit(groups)).cast("int"))


def _along(items: DataFrame) -> tuple[DataFrame, int]:
    """Groups of neighbours by ``at``, numbered in its order: as many documents as half a group's pieces, about."""
    part = F.shiftright("at", ORDER_BITS)
    found = stored(items.sparkSession, items.select(part.alias("_part")).distinct(), "parts")  # a row per 2^13 documents
    numbered = found.withColumn("group", (F.row_number().over(Window.orderBy("_part")) - 1).cast("int"))
    return items.withColumn("_part", part).join(numbered, "_part").drop("_part"), found.count()


def _packed(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """Each group packed in a task of its own: rows are dealt by group number, so no task gets two."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)  # one group: about GROUP_PIECES narrow rows
        if not parts:
            return
        part = pd.concat(parts).sort_values(["length", "doc_id", "piece", "ids_crc32", "copy"],
                                            ascending=[False, True, True, True, True])
        lengths = part["length"].to_numpy(np.int64)
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        certified = len(fills) == lower_bound(lengths, capacity)
        yield part.assign(bin=bins, offset=offsets, settled=(fills[bins] == capacity) | certified)

    dealt = items.select(*[c.split()[0] for c in PIECE.split(", ")], "copy", "group").repartitionById(groups, F.col("group"))
    return dealt.mapInPandas(pack, f"{PIECE}, copy long, group int, bin long, offset long, settled boolean")


def pack(items: DataFrame, capacity: int = 1024, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Deals stored piece rows into sequences of at most ``capacity``: adds ``sequence_id`` and ``offset``.

    Equal rows are separate pieces. Pieces with ``at`` are first grouped along it, and only those of unfilled bins are
    exchanged between groups; others are grouped by hash. Only narrow rows are shuffled, a task holds about ``group_pieces`` of them. The
    exchange stops when a round saves no bins, and each round's result is kept only where it does."""
    spark = items.sparkSession
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = items.where(F.col("length") == capacity).select(
        *columns, (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # Equal rows get a number of their own, so that no group is hot because of them.
    ordered = "at" in items.columns and not items.where("at is not null").isEmpty()
    loose = items.where(F.col("length") < capacity).select(
        *columns, *(["at"] if ordered else []), F.monotonically_increasing_id().alias("copy"))
    done, best, salt = [full], None, 0
    current = stored(spark, loose, "pieces")
    n = current.count()
    while n:
        groups = max(1, -(-n // group_pieces))
        if ordered and salt == 0:
            dealt, groups = _along(current)
        else:
            dealt = _hashed(current, groups, salt)
        new = stored(spark, _packed(dealt, groups, capacity), "packed")
        ids = (F.lit(salt).cast("long") * (1 << 56) + F.col("group").cast("long") * (1 << 28) + F.col("bin"))
        new = new.withColumn("sequence_id", ids)
        bins = F.count_if(F.col("offset") == 0)
        loose_bins, rest = new.where(~F.col("settled")).agg(bins, F.count(F.lit(1))).first()
        if best is not None:
            tried = new.agg(bins.alias("n")).first()["n"]
            if tried >= best[1]:  # the exchange saved nothing: the bins before it stay
                done.append(best[0])
                break
        done.append(new.where(F.col("settled")))
        if not rest:
            break
        best = (new.where(~F.col("settled")), loose_bins)
        salt += 1
        if groups == 1 or salt == rounds:
            done.append(best[0])
            break
        current, n = best[0].select(*columns, "copy"), rest
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part.select(*columns, "sequence_id", "offset"))
    return out


def pack_documents(docs: DataFrame, capacity: int = 1024, vocabulary: Vocabulary = BYTE_BPE, end_id: int = 2,
                   doc_id: str = "doc_id", text: str = "text", order: str | None = None, **options) -> DataFrame:
    """Packs whole documents into sequences of at most ``capacity`` ids (see the module). ``order`` names a column of
    places (a gapless run of 2^13 is one group): neighbours share sequences, and sequence ids ascend along it.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is
    its end id alone; a null doc_id stays null; repeated rows are packed once each; other columns are left out; an
    empty table gives no rows. Token ids themselves are never shuffled."""
    return pack(stored(docs.sparkSession, pieces(docs, capacity, vocabulary, end_id, doc_id, text, order), "pieces"),
                capacity, **options)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir, "doc_id", "text"))
