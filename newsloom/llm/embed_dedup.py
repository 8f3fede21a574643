"""Near-duplicate embeddings: a small-world graph per shard, every shard searched by every vector of its label.

Exact copies are one class. A label's classes are dealt into shards; each shard's graph is built once and stored as one
row. For every two shards of a label, one task searches the first's graph with the second's vectors: a vector whose
beam is half full of links, or full of vectors no farther than just under the threshold, gets a wider one, and an audit
against exact neighbours widens all beams until it passes. Found pairs are verified in double precision; a task gives link counts and a spanning forest, never pairs, and
the forests' edges are joined into components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.util import join_hot_split
from .common import components, stored
from .hnsw import Graph, build
from .vectors import cosines, fingerprinted, units, usable

SHARD_ROWS = 4096
THRESHOLD = 0.98
BEAM = 64
MARGIN = 0.05  # a beam whose last similarity is within it of the threshold may have ended before a link
AUDIT_QUERIES = 256
AUDIT_NEAREST = 10
AUDIT_RECALL = 0.99
GRAPH = "label long, dim int, shard int, rows int, reps binary, copies binary, vectors binary, layers binary, widths binary, links binary"


def _build(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values(["key1", "key2"])
    v = np.stack(part["embedding"].to_numpy()).astype(np.float64)
    graph = build(units(v).astype(np.float32))
    row = part.iloc[0]
    layers = np.concatenate(graph.members).astype("<i4")
    links = np.concatenate([t.reshape(-1) for t in graph.links]).astype("<i4")
    return pd.DataFrame([[row["label"], row["dim"], row["shard"], len(part), part["rep"].to_numpy("<i8").tobytes(),
                          part["copies"].to_numpy("<i8").tobytes(), v.astype("<f8").tobytes(), layers.tobytes(),
                          np.array([len(m) for m in graph.members], "<i4").tobytes(), links.tobytes()]],
                        columns=[c.split()[0] for c in GRAPH.split(", ")])


def _load(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = np.frombuffer(row[f"vectors_{side}"], "<f8").reshape(-1, row["dim"])
    return np.frombuffer(row[f"reps_{side}"], "<i8"), np.frombuffer(row[f"copies_{side}"], "<i8"), v


def _graph(row: dict, x: np.ndarray) -> Graph:
    widths = np.frombuffer(row["widths_i"], "<i4")
    flat = np.frombuffer(row["layers_i"], "<i4").astype(np.int64)
    links = np.frombuffer(row["links_i"], "<i4").astype(np.int64)
    per = len(links) // max(1, widths.sum())
    ends = np.cumsum(widths)
    return Graph(x, np.split(flat, ends[:-1]), [t.reshape(-1, per) for t in np.split(links, ends[:-1] * per)])


def audited_links(graph: Graph, own: np.ndarray, queries: np.ndarray, threshold: float, beam: int = BEAM,
                  same: bool = False) -> np.ndarray:
    """``(queries x points)`` flags of pairs with a cosine of at least ``threshold``; ``own`` and ``queries`` are the
    original vectors. Beams widen until the audited queries' nearest neighbours are found."""
    n, m = len(own), len(queries)
    q32 = units(queries).astype(np.float32)
    loose = threshold - 1e-4
    seed = int.from_bytes(hashlib.blake2b(queries[:1].tobytes() + own[:1].tobytes(), digest_size=4).digest(), "little")
    audit = np.sort(np.random.default_rng(seed).choice(m, min(m, AUDIT_QUERIES), replace=False))
    exact = q32[audit] @ graph.x.T
    k = min(n, AUDIT_NEAREST)
    kth = -np.partition(-exact, k - 1, axis=1)[:, k - 1:k] if k else exact
    while beam < n:
        ids, sims = graph.search(q32[audit], beam)
        found = ((sims >= kth - 1e-6) & (ids >= 0)).sum(1)
        linked = ((sims >= loose) & (ids >= 0)).sum(1) >= np.minimum((exact >= loose).sum(1), beam)
        if np.minimum(found, k).sum() >= AUDIT_RECALL * k * len(audit) and linked.all():
            break
        beam *= 2
    flags = np.zeros((m, n), bool)
    todo = np.arange(m)
    while len(todo) and beam < n:
        wider = []
        for at in range(0, len(todo), 256):
            rows = todo[at:at + 256]
            ids, sims = graph.search(q32[rows], beam)
            r, c = np.nonzero((sims >= loose) & (ids >= 0))
            flags[rows[r], ids[r, c]] = True
            half = (sims[:, beam // 2] >= loose) & (ids[:, beam // 2] >= 0)  # links fill half the beam
            wider.append(rows[half | ((sims[:, -1] >= threshold - MARGIN) & (ids[:, -1] >= 0))])
        todo, beam = np.concatenate(wider), beam * 4
    for at in range(0, len(todo), 256):  # a beam as wide as the shard is a scan
        rows = todo[at:at + 256]
        flags[rows] = q32[rows] @ graph.x.T >= loose
    for at in range(0, m, 256):  # verify in double precision
        r, c = np.nonzero(flags[at:at + 256])
        flags[at + r, c] = cosines(queries[at + r], own[c]) >= threshold
    if same:
        np.fill_diagonal(flags, False)
        flags |= flags.T.copy()
    return flags


def forest(flags: np.ndarray, same: bool) -> np.ndarray:
    """Component (smallest place) of each point; places: the queries, then (unless ``same``) the points."""
    m, n = flags.shape
    comp = np.arange(m if same else m + n)
    for at in range(0, m, 256):
        r, c = np.nonzero(flags[at:at + 256])
        a, b = at + r, c if same else m + c
        while True:
            x, y = comp[a], comp[b]
            apart = x != y
            if not apart.any():
                break
            parent = np.arange(len(comp))
            np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (parent[parent] != parent).any():
                parent = parent[parent]
            comp = parent[comp]
    return comp


def _search(threshold: float):
    def search(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                reps_i, copies_i, v_i = _load(row, "i")
                reps_j, copies_j, v_j = _load(row, "j")
                same = row["shard_i"] == row["shard_j"]
                graph = _graph(row, units(v_i).astype(np.float32))
                flags = audited_links(graph, v_i, v_j, threshold, same=same)
                comp = forest(flags, same)
                reps = reps_j if same else np.concatenate([reps_j, reps_i])
                counts = flags @ copies_i
                if not same:
                    counts = np.concatenate([counts, flags.T @ copies_j])
                some = counts > 0
                yield pd.DataFrame({"a": reps[some], "b": reps[comp[some]], "n": counts[some]})
    return search


def link_vectors(rows: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``rows`` (vec_id, embedding, label) -> vec_id, n_links, component_id, kept, a row per row.

    Vectors that are null, zero or hold null or non-finite components, and null labels or ids, link with nothing;
    vectors of different lengths aren't compared. Every row is compared: rows that repeat an id and its vector count
    once, several vectors of one id are vectors of their own, each with its own links, and stand in one component.
    Other columns are left out; an empty table stays empty."""
    spark = rows.sparkSession
    rows = fingerprinted(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label")))
    good = rows.where(usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    key = ["label", "key1", "key2"]
    chosen = stored(spark, good.select("vec_id", *key).distinct(), "chosen")
    # Equal vectors are one class; its number is unique, as the table is stored.
    classes = stored(spark, chosen.groupBy(*key).agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).withColumn(
        "rep", F.monotonically_increasing_id()), "classes")
    points = good.join(classes.withColumnRenamed("first_id", "vec_id"), [*key, "vec_id"]).select(
        "label", F.size("embedding").alias("dim"), "rep", "copies", "key1", "key2", "embedding").dropDuplicates(["rep"])
    named = stored(spark, chosen.join(classes, key), "named")
    several = named.groupBy("vec_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    same_id = join_hot_split(named.select("vec_id", "rep"), several.select("vec_id", "low"), "vec_id").where("low < rep").select(
        F.col("low").alias("a"), F.col("rep").alias("b"))
    sizes = points.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = points.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("key1", "key2"), "shards").cast("int")).drop("shards")
    graphs = stored(spark, dealt.groupBy("label", "dim", "shard").applyInPandas(_build, GRAPH), "graphs")

    side = lambda s: graphs.select("label", "dim", *[F.col(c.split()[0]).alias(f"{c.split()[0]}_{s}") for c in GRAPH.split(", ")[2:]])
    at = graphs.select("label", "dim", "shard")
    pairs = at.withColumnRenamed("shard", "shard_i").join(at.withColumnRenamed("shard", "shard_j"), ["label", "dim"]).where(
        "shard_i <= shard_j")  # shards of one label: one row per task
    tasks = pairs.join(side("j").drop("layers_j", "widths_j", "links_j"), ["label", "dim", "shard_j"]).join(
        side("i"), ["label", "dim", "shard_i"])
    n = max(1, min(pairs.count(), 100_000))
    tasks = tasks.repartition(n, "label", "dim", "shard_i", "shard_j")
    found = stored(spark, tasks.mapInPandas(_search(threshold), "a long, b long, n long"), "found")

    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    comp = stored(spark, components(spark, found.select("a", "b").union(same_id)).select(
        F.col("node").alias("rep"), "component"), "components")
    least = classes.join(comp, "rep").groupBy("component").agg(F.min("first_id").alias("least"))
    placed = named.join(counts, "rep", "left").join(comp, "rep", "left").join(least, "component", "left").select(
        "vec_id", *key, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "first_id").alias("component_id"))
    out = rows.select("vec_id", *key).join(placed, ["vec_id", *key], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
