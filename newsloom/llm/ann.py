"""Nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample with a balance penalty and searched through an in-memory graph. Every vector
goes to its nearest centroid's posting list, and to further ones that are nearly as near (boundary vectors). A query
probes the lists whose centroid's distance is within a ratio of the nearest one's; the ratio is measured, on audit
queries with exact neighbours, so that the recall target is met. Long lists are scanned in blocks by several tasks.
Exact copies of a vector are indexed once, with as many of their smallest different ids as an answer can need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored
from .hnsw import Graph, build
from .vectors import cosines, fingerprinted, units, usable

SAMPLE_ROWS = 16_000  # vectors that centroids are fitted on, at most
MAX_LISTS = 4096  # centroids held in memory, at most
REPLICAS = 4  # lists of a boundary vector, at most
BOUNDARY = 1.06  # a further list's centroid is at most so many times as far as the nearest
BLOCK_ROWS = 4096  # rows of a list, or of its queries, that a task takes
AUDIT_QUERIES = 128
RECALL = 0.97


def fit_centroids(x: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """``lists`` unit centroids of the unit vectors ``x``. A list over the mean size is penalised in the next round,
    so that lists come out alike in size."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(x))
    c = x[np.sort(rng.choice(len(x), lists, replace=False))].copy()
    penalty = np.zeros(lists)
    for _ in range(rounds):
        near = np.concatenate([(x[a:a + 2048] @ c.T - penalty).argmax(1) for a in range(0, len(x), 2048)])
        sizes = np.bincount(near, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norm = np.linalg.norm(sums, axis=1)
        alive = norm > 1e-9
        c[alive] = sums[alive] / norm[alive][:, None]
        penalty += 0.02 * (sizes / max(1.0, len(x) / lists) - 1)
    return c.astype(np.float32)


def nearest_lists(graph: Graph, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(lists, distances)`` of unit vectors, nearest first; -1 and infinity where the graph found fewer."""
    ids, sims = graph.search(x, min(width, len(graph.x)))
    return ids, np.where(ids >= 0, np.sqrt(np.maximum(2 - 2 * sims, 1e-12)), np.inf)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def best_rows(q: np.ndarray, p: np.ndarray, reps: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, ``(places, cosines)`` of its ``top`` rows of ``p``; ties go to the smaller rep."""
    rough, out = units(q) @ units(p).T, []
    for k in range(len(q)):
        line = rough[k]
        at = np.arange(len(p))
        if len(p) > top:
            at = np.flatnonzero(line >= np.partition(line, len(p) - top)[len(p) - top] - 1e-9)
        exact = cosines(np.broadcast_to(q[k], (len(at), q.shape[1])), p[at])
        order = np.lexsort((reps[at], -exact))[:top]
        out.append((at[order], exact[order]))
    return out


def nearest_others(q: pd.DataFrame, p: pd.DataFrame, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(place in q, places in p, reps, cosines)`` of each query's ``top`` classes of ``p``; those that hold nothing but
    the id ``skip`` of a query with ``own`` are left out, and its other classes stand under their next id."""
    if not len(p) or not len(q):
        return
    x, vectors = _matrix(p["embedding"]), _matrix(q["embedding"])
    rep, second, alone = (p[c].to_numpy() for c in ("rep", "second", "alone"))
    own, skip = q["own"].to_numpy(bool), q["skip"].to_numpy()
    plain = np.flatnonzero(~own)
    groups = [(plain, np.arange(len(p)), rep)] if len(plain) else []
    for one in np.unique(skip[own]):
        groups.append((np.flatnonzero(own & (skip == one)), np.flatnonzero(~(alone & (rep == one))), np.where(rep == one, second, rep)))
    for asks, kept, reps in groups:
        if len(kept):
            for k, (at, score) in zip(asks, best_rows(vectors[asks], x[kept], reps[kept], top)):
                yield int(k), kept[at], reps[kept[at]], score


def search(rows: DataFrame, queries: DataFrame, top: int = 5) -> DataFrame:
    """Each query's ``top`` nearest of ``rows`` (vec_id, embedding) by cosine, its own id left out: query_id, rank
    (from 1), vec_id, score. ``queries``: query_id, embedding.

    Ties go to the smaller vec_id; with fewer rows all are returned. Null ids, and vectors that are null, zero or hold
    null or non-finite components, take no part on either side; nor do vectors that are not of the table's most common
    length. Rows that repeat an id and its vector count once. Repeated ids with other vectors are rows of their own, so
    such an id can stand in an answer once per vector; a query id with several vectors has one answer, in which a row's
    score is the best over them, and all rows of its id are left out. An empty table gives no rows."""
    spark = rows.sparkSession
    need = top + 1
    schema = "query_id long, rank int, vec_id long, score double"
    good = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    common = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common["d"]
    good = fingerprinted(good.where(F.size("embedding") == dim))
    key = ["key1", "key2"]
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("vec_id"))
    ids = good.select(*key, "vec_id").distinct().withColumn("r", copy).where(F.col("r") <= need).groupBy(*key).agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids"))  # at most `need` different ids each
    classes = stored(spark, ids.join(good.groupBy(*key).agg(F.first("embedding").alias("embedding")), key).select(
        F.col("key1").alias("class1"), F.col("key2").alias("class2"), "ids", "embedding", F.col("ids")[0].alias("rep"),
        F.coalesce(F.get("ids", F.lit(1)), F.lit(0)).alias("second"), (F.size("ids") == 1).alias("alone")), "classes")
    asked = fingerprinted(queries.select(F.col("query_id").cast("long").alias("query_id"), "embedding").where(
        F.col("query_id").isNotNull() & usable(F.col("embedding")) & (F.size("embedding") == dim)))
    asked = stored(spark, asked, "queries")

    # One class at most is a query's own where its id has one vector, so top + 1 classes are enough. Queries of the other
    # ids leave their own classes out before any cut, and are units of their own for that.
    several = good.groupBy(F.col("vec_id").alias("query_id")).agg(
        *[f(k).alias(f"{n}{k}") for k in key for n, f in (("x", F.min), ("y", F.max))]).where(
        "xkey1 < ykey1 or xkey2 < ykey2").select("query_id", F.lit(True).alias("own"))
    named = stored(spark, asked.select("query_id", *key).distinct().join(several, "query_id", "left").select(
        "query_id", *key, F.coalesce("own", F.lit(False)).alias("own"),
        F.when(F.col("own"), F.col("query_id")).otherwise(F.lit(0)).alias("skip")), "named")
    unit = [*key, "own", "skip"]
    asks = asked.groupBy(*key).agg(F.first("embedding").alias("embedding")).join(named.select(*unit).distinct(), key)

    n = classes.count()
    sample = classes.orderBy(F.xxhash64("class1", "class2"), "class1", "class2").limit(SAMPLE_ROWS).select("embedding").toPandas()
    lists = int(np.clip(round(np.sqrt(n) / 2), 1, MAX_LISTS))
    centroids = fit_centroids(units(_matrix(sample["embedding"])), lists)
    shared = spark.sparkContext.broadcast(build(centroids))  # at most MAX_LISTS vectors

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = shared.value
        for b in batches:
            ids, far = nearest_lists(graph, units(_matrix(b["embedding"])).astype(np.float32), 32)
            use = (ids >= 0) & (far <= BOUNDARY * far[:, :1]) & (np.arange(ids.shape[1]) < REPLICAS)
            yield b.assign(lists=[i[u].tolist() for i, u in zip(ids, use)])

    held = "class1 long, class2 long, rep long, second long, alone boolean"
    point = [c.split()[0] for c in held.split(", ")] + ["embedding"]
    placed = stored(spark, classes.select(*point).mapInPandas(
        assign, f"{held}, embedding {rows.schema['embedding'].dataType.simpleString()}, lists array<int>"), "postings")
    ratio = _measured_ratio(placed, asks, shared, top)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = shared.value
        for b in batches:
            ids, far = nearest_lists(graph, units(_matrix(b["embedding"])).astype(np.float32), len(graph.x))
            use = (ids >= 0) & (far <= ratio * far[:, :1])
            yield b.assign(lists=[i[u].tolist() for i, u in zip(ids, use)])

    kind = queries.schema["embedding"].dataType.simpleString()
    probed = stored(spark, asks.select(*unit, "embedding").mapInPandas(
        probe, f"key1 long, key2 long, own boolean, skip long, embedding {kind}, lists array<int>"), "probes")
    found = stored(spark, _scanned(placed, classes, probed, unit, point, need), "hits")
    # Queries whose probed lists hold fewer others than asked for are compared with every list.
    full = found.groupBy(*unit).count().where(F.col("count") >= need)
    short = probed.join(full, unit, "left_anti").where(F.size("lists") < len(centroids)).select(*unit, "embedding").withColumn(
        "lists", F.sequence(F.lit(0), F.lit(len(centroids) - 1)))
    if not short.isEmpty():
        short = stored(spark, short, "short")
        found = found.join(short.select(*unit), unit, "left_anti").unionByName(
            _scanned(placed, classes, short, unit, point, need))

    answer = named.join(found, unit).where(F.col("query_id") != F.col("vec_id")).groupBy(
        "query_id", "vec_id", "class1", "class2").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answer.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _scanned(placed: DataFrame, classes: DataFrame, probed: DataFrame, unit: list[str], point: list[str], need: int) -> DataFrame:
    """The ``need`` best rows of the probed lists for each query: unit, class1, class2, score, vec_id."""
    # Long lists, and lists of many queries, are cut into blocks; each block of one meets each of the other.
    held = placed.select(*point, F.explode("lists").alias("list"))
    wants = probed.select(*unit, "embedding", F.explode("lists").alias("list"))
    blocks = held.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("rows_n")).join(
        wants.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("asks_n")), "list")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    held = held.join(blocks, "list").withColumn("rb", F.pmod(F.xxhash64("class1", "class2"), "rows_n").cast("int")).withColumn(
        "qb", each("asks_n"))
    wants = wants.join(blocks, "list").withColumn("qb", F.pmod(F.xxhash64(*unit), "asks_n").cast("int")).withColumn("rb", each("rows_n"))
    spot = ["list", "rb", "qb"]
    columns = [*unit, "class1", "class2", "rep", "score"]

    def scan(_, p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        parts = list(nearest_others(q, p, need))
        if not parts:
            return pd.DataFrame({c: [] for c in columns})
        asks = np.repeat([k for k, *_ in parts], [len(at) for _, at, *_ in parts])
        at = np.concatenate([a for _, a, *_ in parts])
        return pd.DataFrame({**{c: q[c].to_numpy()[asks] for c in unit}, **{c: p[c].to_numpy()[at] for c in ("class1", "class2")},
                             "rep": np.concatenate([r for *_, r, _ in parts]), "score": np.concatenate([s for *_, s in parts])})

    hits = held.select(*spot, *point).groupBy(*spot).cogroup(wants.select(*spot, *unit, "embedding").groupBy(*spot)).applyInPandas(
        scan, "key1 long, key2 long, own boolean, skip long, class1 long, class2 long, rep long, score double")
    order = Window.partitionBy(*unit).orderBy(F.desc("score"), "rep")
    hits = hits.groupBy(*unit, "class1", "class2").agg(F.max("score").alias("score"), F.min("rep").alias("rep")).withColumn(
        "r", F.row_number().over(order)).where(F.col("r") <= need).drop("r", "rep")
    ids = hits.join(classes.select("class1", "class2", "ids"), ["class1", "class2"]).select(
        *unit, "class1", "class2", "score", F.explode("ids").alias("vec_id")).where(~F.col("own") | (F.col("vec_id") != F.col("skip")))
    return ids.withColumn("r", F.row_number().over(Window.partitionBy(*unit).orderBy(F.desc("score"), "vec_id"))).where(
        F.col("r") <= need).drop("r")


def _measured_ratio(placed: DataFrame, asked: DataFrame, shared, top: int) -> float:
    """The least distance ratio at which RECALL of the audit queries' exact neighbours stand in a probed list.

    At most AUDIT_QUERIES queries are compared with every indexed vector; tasks return their best few each."""
    audit = asked.orderBy(F.xxhash64("key1"), "key1", "key2", "skip").limit(AUDIT_QUERIES).toPandas()
    if not len(audit):
        return 1.0
    q = _matrix(audit["embedding"])
    sent = placed.sparkSession.sparkContext.broadcast(audit)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for b in batches:
            if not len(b):
                continue
            found = [pd.DataFrame({"query": k, "score": s, "lists": b["lists"].to_numpy()[a]}) for k, a, _, s in
                     nearest_others(sent.value, b, top + 1)]
            if not found:
                continue
            kept = pd.concat(found if kept is None else [kept, *found])
            kept = kept.sort_values("score", ascending=False, kind="stable").groupby("query").head(top + 1)
        if kept is not None:
            yield kept

    best = placed.mapInPandas(exact, "query int, score double, lists array<int>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    best = best.withColumn("r", rank).where(F.col("r") <= top + 1).toPandas()  # at most AUDIT_QUERIES x (top + 1)
    ids, far = nearest_lists(shared.value, units(q).astype(np.float32), len(shared.value.x))
    needed = []
    for row in best.itertuples():
        place = {int(i): f for i, f in zip(ids[row.query], far[row.query] / far[row.query, 0]) if i >= 0}
        needed.append(min((place.get(int(i), np.inf) for i in row.lists), default=np.inf))
    if not needed:
        return 1.0
    needed = np.sort(needed)
    ratio = float(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))])
    return ratio * (1 + 1e-6)


def op5_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    queries = rows.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return search(rows, queries)
