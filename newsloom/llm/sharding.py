"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of the ring, and a key belongs to the next point clockwise of its hash. A shard takes
at most its capacity: what does not fit continues clockwise to the next shard with room. Which keys move on is worked
out on counts per arc of the ring (a table whose size is shards x virtual nodes, whatever the data), as ranges of the
keys' ranks inside their arc; then each row looks its rank up. No text is shuffled.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored

VIRTUAL_NODES = 64
PARTS = 32  # ranks inside an arc are counted in so many parts, each one window


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """``(points, owners)`` in ring order; points are signed 64-bit, as Spark's hashes are."""
    points = sorted((int(np.int64(np.uint64(xxhash.xxh64_intdigest(f"{s}#{v}")))), s)
                    for s in range(shards) for v in range(virtual_nodes))
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int64)


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Without slack, all shares but one row alike; with slack, ``(1 + slack)`` times the mean each."""
    if slack:
        return [int(np.ceil((1 + slack) * rows / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def spread(counts: np.ndarray, owners: np.ndarray, room: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each arc, the ``(rank from, shard, slot of that rank)`` of its runs of ranks.

    All arcs fill their own shard first, then what is over moves clockwise, one point a round, until all lies
    somewhere; a shard takes what stands at its points in ring order."""
    free, used = list(room), [0] * len(room)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    moving = [(a, a, 0, int(n)) for a, n in enumerate(counts) if n]  # point, arc, first rank, rows
    while moving:
        over = []
        for point, arc, rank, n in moving:
            shard = int(owners[point])
            took = min(n, free[shard])
            if took:
                runs[arc].append((rank, shard, used[shard]))
                free[shard] -= took
                used[shard] += took
            if took < n:
                if not sum(free):
                    raise ValueError("the shards have less room than rows")
                over.append(((point + 1) % len(owners), arc, rank + took, n - took))
        moving = sorted(over)
    return runs


def part_of(order: tuple[str, ...] = ()) -> Column:
    return F.pmod(F.xxhash64("_h", *order), F.lit(PARTS)).cast("int")


def bounded_ring(rows: DataFrame, shards: int, key: str = "doc_id", slack: float = 0.0,
                 virtual_nodes: int = VIRTUAL_NODES, order: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``shard`` and ``slot`` (gapless from 0 in its shard) to ``rows``.

    Rows of one arc are ranked by a part, a hash of the key and the columns ``order``, so that rows of a hot key are
    ranked in many windows; inside a part by the hash of ``key``, the key and ``order``. Equal rows are interchangeable
    and stand in one part. A null key has a hash like any other. An empty table stays empty."""
    spark = rows.sparkSession
    points, owners = ring(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(hashes: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, hashes.to_numpy(), "left") % len(points))

    hashed = rows.withColumn("_h", F.xxhash64(F.col(key)))
    hashed = hashed.withColumn("_arc", arc_of("_h")).withColumn(
        "_part", part_of(order))
    hashed = stored(spark, hashed, "arcs")
    found = hashed.groupBy("_arc", "_part").agg(F.count(F.lit(1)).alias("n")).collect()  # at most arcs x parts
    counts = np.zeros((len(points), PARTS), np.int64)
    for a, p, n in found:
        counts[a, p] = n
    starts = np.cumsum(counts, axis=1) - counts
    runs = spread(counts.sum(axis=1), owners, capacities(int(counts.sum()), shards, slack))
    shared = spark.sparkContext.broadcast((starts, runs))  # bounded by the ring, not by the rows

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, runs = shared.value
        froms = [[r[0] for r in x] for x in runs]
        for b in batches:
            arc, at = b["_arc"].to_numpy(), starts[b["_arc"], b["_part"]] + b["_rank"]
            mine = [runs[a][bisect_right(froms[a], r) - 1] for a, r in zip(arc.tolist(), at.tolist())]
            yield b.drop(columns=["_arc", "_part", "_rank"]).assign(
                shard=np.array([m[1] for m in mine], np.int32),
                slot=np.array([m[2] + r - m[0] for m, r in zip(mine, at.tolist())], np.int64))

    rank = F.row_number().over(Window.partitionBy("_arc", "_part").orderBy("_h", key, *order)) - 1
    ranked = hashed.withColumn("_rank", rank).drop("_h")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return ranked.mapInPandas(place, f"{fields}, shard int, slot long")


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text",
                    slack: float = 0.0) -> DataFrame:
    """Puts all ``docs`` on ``shards`` shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Without slack the counts of two shards differ by one row at most (law ``rows``). A null text has size 1 and
    a null crc, an empty one size 1; a null doc_id is placed like any key; repeated rows each get a slot; other
    columns are left out."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return bounded_ring(rows, shards, slack=slack, order=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir, "doc_id", "text"), 16)
