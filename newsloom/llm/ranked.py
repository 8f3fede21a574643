"""Ranked lexical search by dense matrix products in blocks.

Items are cut into tiles, each with a compact vocabulary: only the terms of its own items. Documents become tiles of
term impacts. A tile pair is one BLAS product in float64: document impacts (rows) times item weights (columns). All
factors are whole numbers, and a tile's columns are cut so that no partial sum reaches 2^53, so the products are exact
and are added as 64-bit integers. A task keeps each item's best documents; what equals the last kept score stays in
play until the ids decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored
from .tokenize import slices

TOP = 10
PASS_TERMS = 1 << 18  # item terms sent to the tasks at a time, about
TILE_ITEMS = 256
TILE_DOCS = 512
TILE_CELLS = 1 << 22
EXACT = 1 << 53
MAX_IMPACT = 1_000_000  # an impact stays below it

# Byte table: A-Z to a-z; ASCII bytes that belong to no term to a space. Bytes of other characters stay.
_TABLE = np.full(256, 32, np.uint8)
for _first, _last in (("0", "9"), ("a", "z")):
    _TABLE[ord(_first):ord(_last) + 1] = np.arange(ord(_first), ord(_last) + 1)
_TABLE[65:91] = np.arange(97, 123)
_TABLE[128:] = np.arange(128, 256)


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(chunks, row, real)``: the pieces between separators of all texts, the text each is from, and whether it is a
    term (not empty). Null: none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, bool)
    plain = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(_TABLE[np.frombuffer(data, np.uint8)]),
                                        None, 0, texts.offset)
    lists = pc.split_pattern(plain, " ")
    chunks = lists.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    return chunks, row, pc.binary_length(chunks).to_numpy(zero_copy_only=False) > 0


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(item_id, term, uses)``. Equal rows count once; of several texts with one id all terms are used."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                chunks, row, real = split_terms(part.column("text"))
                at = pa.array(np.flatnonzero(real))
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(row[real])), chunks.take(at)],
                                                 ["item_id", "term"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).distinct()
    return rows.mapInArrow(split, "item_id long, term string").groupBy("item_id", "term").agg(
        F.count(F.lit(1)).alias("uses"))


def term_counts(docs: DataFrame, terms) -> DataFrame:
    """One row per document with at least one term: doc_id, n (its terms with repeats), and of the broadcast sorted
    ``terms`` those it holds: ``cols`` (their places) with ``tfs``. ``docs``: doc_id, text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        width = len(known)
        for batch in batches:
            for part in slices(batch, "text"):
                chunks, row, real = split_terms(part.column("text"))
                n = np.bincount(row[real], minlength=part.num_rows)
                code = pc.fill_null(pc.index_in(chunks, value_set=known), -1).to_numpy()
                hit = code >= 0
                pair, tf = np.unique(row[hit] * width + code[hit], return_counts=True)
                keep = np.flatnonzero(n)
                ends = np.cumsum(np.bincount(pair // width, minlength=part.num_rows))[keep]
                bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(keep)), pa.array(n[keep], pa.int64()),
                    pa.ListArray.from_arrays(bounds, pa.array(pair % width, pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int32()))], ["doc_id", "n", "cols", "tfs"])

    return docs.mapInArrow(count, "doc_id long, n long, cols array<int>, tfs array<int>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Tile:
    """Items ``first ..`` of a pass. ``vocabulary``: the pass's terms that they use, ascending. ``blocks``: item
    weights, items x vocabulary, each block with partial sums under 2^53."""
    first: int
    vocabulary: np.ndarray
    blocks: list[np.ndarray]


def weight_blocks(weights: np.ndarray) -> list[np.ndarray]:
    """Whole weights (items x terms) as a sum of float64 matrices, in each of which every item's weights times
    MAX_IMPACT add up to less than 2^53."""
    limit = EXACT // MAX_IMPACT - 1
    blocks = []
    left = weights.astype(np.int64)
    while True:
        before = np.minimum(np.cumsum(left, axis=1), limit)  # what of each item's weights fits this block
        block = np.diff(before, axis=1, prepend=0)
        blocks.append(block.astype(np.float64))
        left = left - block
        if not left.any():
            return blocks


def tiles(item: np.ndarray, col: np.ndarray, weight: np.ndarray, size: int) -> list[Tile]:
    """Tiles of at most ``size`` items and, but for single items, TILE_CELLS weights. The triples are sorted by item."""
    out = []
    bounds = np.concatenate([np.flatnonzero(np.diff(item, prepend=-1)), [len(item)]])  # items are 0, 1, ...
    first = 0
    while first + 1 < len(bounds):
        until = first + 1
        while until + 1 < len(bounds) and until - first < size and (
                (until + 1 - first) * (bounds[until + 1] - bounds[first]) <= TILE_CELLS):
            until += 1
        a, b = bounds[first], bounds[until]
        vocabulary, place = np.unique(col[a:b], return_inverse=True)
        dense = np.zeros((until - first, len(vocabulary)), np.int64)
        dense[item[a:b] - first, place] = weight[a:b]
        out.append(Tile(first, vocabulary, weight_blocks(dense)))
        first = until
    return out


class Best:
    """Each item's highest-scoring documents so far, equal scores by ascending id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top, self.floor = top, np.ones(items, np.int64)  # a score under the floor can't get in
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.none = np.zeros(0, bool)

    def offer(self, first: int, scores: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        """``scores``: documents x items of a tile that begins with item ``first``."""
        n, width = scores.shape
        floor = self.floor[first:first + width]
        if n > self.top:  # at least ``top`` documents of the tile reach this
            floor = np.maximum(floor, np.partition(scores, n - self.top, axis=0)[n - self.top])
        row, item = np.nonzero(scores >= floor)  # ties with the last place included
        if not len(row):
            return
        item_all = np.concatenate([self.item, item + first])
        score = np.concatenate([self.score, scores[row, item]])
        docs, nones = np.concatenate([self.doc, doc[row]]), np.concatenate([self.none, none[row]])
        order = np.lexsort((docs, nones, -score, item_all))
        item_all = item_all[order]
        place = np.arange(len(order)) - np.searchsorted(item_all, item_all)
        keep = order[place < self.top]
        last = order[place == self.top - 1]
        self.floor[np.concatenate([self.item, item + first])[last]] = score[last]
        self.item = np.concatenate([self.item, item + first])[keep]
        self.score, self.doc, self.none = score[keep], docs[keep], nones[keep]


def _ranked(counts: DataFrame, plan, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """Each task's best documents of every item: item, doc_id, score."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items, parts = plan.value
        best = Best(n_items, top)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                lists = part.column("cols")
                held = np.diff(np.asarray(lists.offsets))
                row = np.repeat(np.arange(part.num_rows), held)
                col = lists.flatten().to_numpy()
                n = part.column("n").to_numpy()
                impact = impacts(part.column("tfs").flatten().to_numpy().astype(np.int64), n[row], n_docs, n_terms)
                ids = part.column("doc_id")
                none = ids.is_null().to_numpy(zero_copy_only=False)
                doc = ids.fill_null(0).to_numpy()
                for tile in parts:
                    own = np.minimum(np.searchsorted(tile.vocabulary, col), len(tile.vocabulary) - 1)
                    hit = tile.vocabulary[own] == col
                    used, place = np.unique(own[hit], return_inverse=True)
                    if not len(used):
                        continue
                    docs_tile = np.zeros((part.num_rows, len(used)))
                    docs_tile[row[hit], place] = impact[hit]
                    scores = np.zeros((part.num_rows, len(tile.blocks[0])), np.int64)
                    for block in tile.blocks:
                        scores += (docs_tile @ block[:, used].T).astype(np.int64)
                    best.offer(tile.first, scores, doc, none)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc, mask=best.none), pa.array(best.score)], ["item", "doc_id", "score"])

    return counts.mapInArrow(multiply, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", pass_terms: int = PASS_TERMS,
           tile_items: int = TILE_ITEMS) -> DataFrame:
    """The ``top`` highest-scoring documents of every item: item_id, rank, doc_id, score (see the module).

    Every row of ``docs`` is a document; equal scores go by ascending id, null ids last. Rows of ``items`` that are
    equal count once; an id (null too) with several texts uses the terms of all. Null and empty texts have no terms;
    an item without a scoring document, and empty tables, give no rows; other columns are left out. Texts of any
    length are read whole.

    Items are dealt into passes of about ``pass_terms`` item terms, so what is sent to the tasks is bounded; each pass
    reads the documents once, stores their counts of the pass's terms, and multiplies those tiles."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).alias("text"))
    asked = stored(spark, item_terms(items, item_id, item_text), "asked")
    passes = max(1, -(-asked.count() // pass_terms))
    turn = F.pmod(F.xxhash64("item_id"), F.lit(passes))
    found = None
    for k in range(passes):
        own = asked.where(turn == k).toArrow()  # about pass_terms rows
        if not own.num_rows:
            continue
        vocabulary = pc.unique(own["term"].combine_chunks())
        shared = spark.sparkContext.broadcast(vocabulary)
        counts = stored(spark, term_counts(texts, shared), "counts")
        n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in counts.select(F.explode("cols").alias("c")).groupBy("c").count().collect():
            df[r["c"]] = r["count"]
        weight = np.array([term_weight(n_docs, int(d)) for d in df], np.int64)
        names = own["item_id"].to_pylist()
        place = {v: i for i, v in enumerate(dict.fromkeys(names))}
        item = np.array([place[v] for v in names], np.int64)
        col = pc.index_in(own["term"].combine_chunks(), value_set=vocabulary).to_numpy().astype(np.int64)
        order = np.lexsort((col, item))
        values = (own["uses"].to_numpy() * weight[col])[order]
        plan = spark.sparkContext.broadcast((len(place), tiles(item[order], col[order], values, tile_items)))
        named = spark.createDataFrame([(i, v) for v, i in place.items()], "item long, item_id long")
        part = _ranked(counts, plan, n_docs, n_terms, top).join(named, "item").drop("item")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")


def op11_blas_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
