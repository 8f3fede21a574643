"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of half keys, each made of a few min-hashes, are paired into a table key for every pair: m + m
half keys give m x m tables, so the min-hash work is about the square root of what separate tables would need. Two
documents share a table exactly if they share a half key in both collections. Candidates are confirmed on their
full shingle sets.

Documents with the same set are one class from the start. In every bucket, all classes are first compared with the
bucket's smallest, and the links found are joined into components. Classes that buckets tie together form a cluster;
where a cluster still has several components, its classes are put into blocks by component, and one task per two blocks
compares every class with every other by marking its shingles in the blocks' list, giving a spanning forest. Two blocks
of one component are left out. So a group of near copies costs its own length, no pairs are written for the
rest, no link between components is lost, and no bucket is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.util import join_hot_split
from .common import components, documents, stored
from .shingles import mix64, shingle_sets
from .tokenize import slices

HALVES = 16  # half keys in each of the two collections: 256 tables from 32 half keys
BLOCK_SHINGLES = 400_000  # shingles of the classes in a block, about
HALF_HASHES = 3  # min-hashes in a half key: at similarity 0.8 a pair is in no common table with chance 2e-5
PERCENT = 80


def _multipliers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def half_keys(sets: list[np.ndarray], halves: int, hashes: int, seed: int = 11) -> np.ndarray:
    """Per set, ``2 x halves`` 64-bit half keys of ``hashes`` min-hashes each."""
    mul, add = _multipliers(2 * halves * hashes, seed)
    low = np.empty((len(sets), len(mul)), np.uint64)
    with np.errstate(over="ignore"):
        for k, own in enumerate(sets):
            best = None
            for at in range(0, len(own), 1024):
                part = (own[None, at:at + 1024] * mul[:, None] + add[:, None]).min(axis=1)
                best = part if best is None else np.minimum(best, part)
            low[k] = best
        low = low.reshape(len(sets), 2 * halves, hashes)
        key = np.zeros((len(sets), 2 * halves), np.uint64)
        for j in range(hashes):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low[:, :, j])
    return key


SKETCH = "doc_id long, text_hash long, n_shingles long, key1 long, key2 long, first array<long>, second array<long>"


def sketches(docs: DataFrame, width: int, halves: int = HALVES, hashes: int = HALF_HASHES) -> DataFrame:
    """``docs`` (doc_id, text) -> a hash of the text, n_shingles, the set's 128-bit fingerprint, and both collections of
    half keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 3 << 20):
                sets = shingle_sets(part.column("text"), width)
                full = [s for s in sets if len(s)]
                keys = half_keys(full, halves, hashes).view(np.int64)
                at = np.cumsum([len(s) > 0 for s in sets]) - 1
                prints = _prints(sets)
                rows = [keys[a] if len(s) else None for a, s in zip(at, sets)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0]),
                     pa.array(prints[:, 1]),
                     *[pa.array([None if r is None else r[c * halves:(c + 1) * halves] for r in rows], pa.list_(pa.int64()))
                       for c in range(2)]],
                    [c.split()[0] for c in SKETCH.split(", ")])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(sketch, SKETCH)


def _prints(sets: list[np.ndarray]) -> np.ndarray:
    """128-bit fingerprints of whole sets, as two signed columns."""
    with np.errstate(over="ignore"):
        found = [(mix64(s).sum(), mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum()) for s in sets]
    return np.array(found, np.uint64).reshape(-1, 2).view(np.int64)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` (doc_id, text, key1, key2) -> doc_id, shingles (the whole set), where the set's fingerprint is the keys."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 3 << 20):
                sets = shingle_sets(part.column("text"), width)
                prints = _prints(sets)
                same = (prints[:, 0] == part.column("key1").to_numpy()) & (prints[:, 1] == part.column("key2").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").filter(pa.array(same)),
                     pa.array([s.view(np.int64) for s, fits in zip(sets, same) if fits], pa.list_(pa.int64()))],
                    ["doc_id", "shingles"])

    return docs.mapInArrow(build, "doc_id long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose sets' intersection is at least ``percent`` / 100 of their union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("sa", "sb"))
    rows = both.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
    return rows.where(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("a", "b")


def _block_links(percent: int):
    """A spanning forest of the links between two blocks (or inside one), as pairs of the components of class and root."""

    def link(part):
        import pandas as pd
        part = part.sort_values(["block", "rep"])
        reps, size = part["rep"].to_numpy(), part["shingles"].map(len).to_numpy(np.int64)
        ids = np.unique(np.concatenate(part["shingles"].to_list()), return_inverse=True)[1]
        begin = np.cumsum(size) - size
        inside = part["b1"].iloc[0] == part["b2"].iloc[0]
        second = len(reps) if inside else int((part["block"] == part["b1"]).sum())
        mark, root = np.zeros(int(ids.max()) + 1, bool), np.arange(len(reps))
        for k in range(second):
            to = k + 1 if inside else second  # compare with those after it, or with the other block
            if to >= len(reps):
                break
            own = ids[begin[k]:begin[k] + size[k]]
            mark[own] = True
            common = np.add.reduceat(mark[ids[begin[to]:]], begin[to:] - begin[to], dtype=np.int64)
            mark[own] = False
            hit = to + np.flatnonzero(100 * common >= percent * (size[k] + size[to:] - common))
            if len(hit):
                tied = np.unique(root[np.append(hit, k)])
                root[np.isin(root, tied)] = tied[0]
        some = root != np.arange(len(reps))
        comp = part["component"].to_numpy()
        return pd.DataFrame({"a": comp[some], "b": comp[root[some]]})

    return link


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT, halves: int = HALVES,
                    hashes: int = HALF_HASHES) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, kept (doc_id = component_id), a row per row.

    Rows with one doc_id are one document, perhaps with several texts: it links where any of them does, and all its
    rows are in one component; each row has its own text's n_shingles. A null doc_id has no component and is kept. Null
    and empty texts, and texts of white space, have no shingles and link with nothing. Texts of any length are read
    whole. Other columns are left out; an empty table stays empty."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(spark, sketches(docs, width, halves, hashes), "sketches")
    key = ["key1", "key2", "n_shingles"]
    real = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # A class is a set; one text of its smallest document stands for it, and its half keys are taken from that text.
    # Its number is unique, as the table is stored.
    smallest = F.min(F.struct("doc_id", "text_hash", "first", "second"))
    classes = stored(spark, real.groupBy(*key).agg(smallest.alias("d"), F.max("doc_id").alias("last")).select(
        *key, "d.*", (F.col("d.doc_id") < F.col("last")).alias("many"), F.monotonically_increasing_id().alias("rep")), "classes")
    named = stored(spark, real.select("doc_id", *key).join(classes.select(*key, "rep"), key).select("doc_id", "rep"), "named")
    # Classes of one document's texts are tied to the smallest of them.
    several = named.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    same_id = stored(spark, join_hot_split(named, several.select("doc_id", "low"), "doc_id").where(
        "low < rep").select(F.col("low").alias("a"), F.col("rep").alias("b")), "same-id")

    # Tables of half keys that only one class has can hold no pair, so those are left out before pairing.
    one = classes.select("rep", F.posexplode(F.concat("first", "second")).alias("k", "half"))
    shared = one.groupBy("k", "half").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x < y").select("k", "half")
    tables = one.join(shared, ["k", "half"]).groupBy("rep").agg(F.collect_list(F.struct("k", "half")).alias("own"))
    tables = stored(spark, tables.select("rep", *[F.filter("own", test).alias(name) for name, test in (
        ("first", lambda h: h["k"] < halves), ("second", lambda h: h["k"] >= halves))]), "tables")  # at most `halves` each
    keys = tables.select("rep", F.explode("first").alias("f"), "second").select(
        "rep", "f", F.explode("second").alias("s")).select("rep", F.xxhash64("f.k", "f.half", "s.k", "s.half").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("y")).where("a < y").select("key", "a")
    stars = stored(spark, keys.join(buckets, "key").where("a < rep").select("a", F.col("rep").alias("b")).distinct(), "pairs")

    wanted = stars.select(F.col("a").alias("doc_id")).union(stars.select(F.col("b").alias("doc_id"))).distinct()
    # Only the texts that stand for classes are read again, repeated rows once; the join's partitioning serves distinct()
    # too, so texts move once and sets not at all.
    asked = classes.select("doc_id", "text_hash", "rep", "key1", "key2").join(wanted.select(F.col("doc_id").alias("rep")), "rep")
    texts = docs.withColumn("text_hash", F.xxhash64("text")).join(asked, ["doc_id", "text_hash"]).select(
        "doc_id", "text_hash", "rep", "text", "key1", "key2").distinct().select(F.col("rep").alias("doc_id"), "text", "key1", "key2")
    sets = stored(spark, full_sets(texts, width), "sets")
    sizes = classes.select("rep", "n_shingles")
    ratio = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)  # noqa: E731  no pair beyond it can reach the similarity
    fitting = stars.join(sizes.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na")), "a").join(
        sizes.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb")), "b").where(ratio(F.col("na"), F.col("nb"))).select("a", "b")
    links = stored(spark, confirmed(fitting, sets, percent), "links")

    comp = components(spark, links).withColumnRenamed("node", "rep")

    def joined(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes as pairs of their components, where those differ."""
        for side in ("a", "b"):
            pairs = pairs.join(comp.select(F.col("rep").alias(side), "component"), side, "left").withColumn(
                side, F.coalesce("component", side)).drop("component")
        return pairs.where("a != b").select("a", "b").distinct()

    # Clusters of classes that buckets tie together; those with several components are compared in blocks. Components
    # that buckets tie to no other are in none of them.
    clusters = components(spark, joined(stars)).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    placed = sizes.join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep")).join(clusters, "component")
    so_far = F.sum("n_shingles").over(Window.partitionBy("cluster").orderBy("component", "rep"))
    placed = stored(spark, placed.withColumn("block", F.floor((so_far - F.col("n_shingles")) / BLOCK_SHINGLES)), "blocks")
    blocks = placed.groupBy("cluster", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    x, y = blocks.alias("x"), blocks.alias("y")
    one = (F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low"))
    tasks = x.join(y, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.block") <= F.col("y.block")) & ~one).select(
        "x.cluster", F.col("x.block").alias("b1"), F.col("y.block").alias("b2"))
    tasks = tasks.withColumn("block", F.explode(F.array_distinct(F.array("b1", "b2"))))
    rows_in = placed.select("cluster", "block", "rep", "component").join(tasks, ["cluster", "block"]).join(
        sets.withColumnRenamed("doc_id", "rep"), "rep")
    more = rows_in.groupBy("cluster", "b1", "b2").applyInPandas(_block_links(percent), "a long, b long")
    final = components(spark, more.union(joined(same_id))).select(F.col("node").alias("component"), F.col("component").alias("final"))

    # Classes that other documents or classes are in one component with.
    found = classes.select("rep", "doc_id", "many").join(comp, "rep", "left").withColumn("linked", F.col("component").isNotNull()).withColumn(
        "component", F.coalesce("component", "rep")).join(final, "component", "left").where(
        F.col("many") | F.col("linked") | F.col("final").isNotNull()).select("rep", "doc_id", F.coalesce("final", "component").alias("component"))
    found = stored(spark, found, "found")
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = named.join(found.drop("doc_id").join(least, "component"), "rep").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"))
    out = rows.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"), width=2)
