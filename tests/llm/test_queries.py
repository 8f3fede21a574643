"""The registered queries on a whole small table set, by their own parameters, against plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from newsloom.llm import queries, sharding
from newsloom.llm.tokenize import PLAIN_WORD_BPE

from .test_llm import SF, brute_groups, library


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF}/{n}.parquet").collect() for n in ("documents", "embeddings", "conversations")}


def run(spark, name):
    return queries.registry()[name](spark, SF)


def test_every_operator_has_one_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.registry())
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.registry())


def test_op1(spark, tables):
    own = library(PLAIN_WORD_BPE)
    got = {r["doc_id"]: r["n_tokens"] for r in run(spark, "op1_separator_scan").collect()}
    assert got == {r["doc_id"]: len(own.encode(r["text"] or "", add_special_tokens=False).ids) for r in tables["documents"]}


def test_op2(spark, tables):
    got = run(spark, "op2_bounded_ring").toPandas()
    assert got.columns.tolist()[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    text = {r["doc_id"]: (r["text"] or "").encode() for r in tables["documents"]}
    assert {r.doc_id: (r.size_, r.text_crc32) for r in got.rename(columns={"size": "size_"}).itertuples()} == {
        i: (len(t) + 1, zlib.crc32(t)) for i, t in text.items()}
    counts = got.groupby("shard").size()
    assert len(counts) == 16 and counts.max() - counts.min() <= 1 and set(got.law) == {"rows"} and got.grown_shard.isna().all()
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard").slot)


def test_ring_equals_a_plain_walk(spark):
    """Keys one by one, by arc and hash: each goes to its arc's owner, or clockwise to the first shard with room."""
    import pandas as pd
    from pyspark.sql import functions as F
    keys = spark.range(3000).withColumnRenamed("id", "doc_id")
    for slack in (0.0, 0.1):
        got = sharding.bounded_ring(keys, 7, slack=slack).toPandas().set_index("doc_id").shard
        points, owners = sharding.ring(7, sharding.VIRTUAL_NODES)
        room = list(sharding.capacities(3000, 7, slack))
        hashes = keys.withColumn("h", F.xxhash64("doc_id")).withColumn("p", F.pmod("h", F.lit(sharding.PARTS))).toPandas()
        hashes["arc"] = np.searchsorted(points, hashes.h.to_numpy(), "left") % len(points)
        # The arcs' own keys come first, as far as their shard has room; what overflows moves on one point at a time.
        moving = defaultdict(int)
        for a, n in hashes.groupby("arc").size().items():
            moving[a] = n
        want = pd.Series(0, index=range(7))
        while moving:
            further = defaultdict(int)
            for a in sorted(moving):
                took = min(moving[a], room[owners[a]])
                room[owners[a]] -= took
                want[owners[a]] += took
                if moving[a] > took:
                    further[(a + 1) % len(points)] += moving[a] - took
            moving = further
        assert got.groupby(got).size().reindex(range(7), fill_value=0).tolist() == want.tolist()


def test_op5(spark, tables):
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in tables["embeddings"] if r["embedding"] is not None}
    ids = np.array(sorted(x))
    m = np.stack([x[i] for i in ids])
    m = m / np.linalg.norm(m, axis=1)[:, None]
    got = run(spark, "op5_posting_lists").toPandas()
    asked = [i for i in ids if i % 50 == 0]
    hits = total = 0
    for q in asked:
        score = m @ m[np.searchsorted(ids, q)]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:5]
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == [1, 2, 3, 4, 5] and own.score.is_monotonic_decreasing
        assert np.allclose(own.score, [score[np.searchsorted(ids, v)] for v in own.vec_id], atol=1e-12)
        hits, total = hits + len(set(ids[order]) & set(own.vec_id)), total + 5
    assert set(got.query_id) == set(asked) and hits >= 0.9 * total


def test_op6(spark, tables):
    got = run(spark, "op6_factorisation_machine").toPandas()
    assert sorted(got.doc_id) == sorted(r["doc_id"] for r in tables["documents"])
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()


def test_op8(spark, tables):
    rows = [(r["vec_id"], np.array(r["embedding"], float), r["label"]) for r in tables["embeddings"] if r["embedding"] is not None]
    got = {r["vec_id"]: r for r in run(spark, "op8_hnsw_dedup").collect()}
    assert len(got) == len(tables["embeddings"])
    for i, v, g in rows:
        near = [j for j, w, h in rows if j != i and g is not None and g == h and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98]
        assert got[i]["n_links"] == len(near) and (got[i]["component_id"] <= min([i, *near]))
        assert got[i]["kept"] == (got[i]["component_id"] == i)


def test_op9(spark, tables):
    want = brute_groups([(r["doc_id"], r["text"]) for r in tables["documents"]], 2)
    got = run(spark, "op9_tensored_minhash").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_op10(spark, tables):
    turns = defaultdict(list)
    for r in sorted(tables["conversations"], key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-7] = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]
    got = {r["conv_id"]: r for r in run(spark, "op10_reply_trees").collect()}
    assert set(got) == set(turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, own in turns.items():
        said = "".join(t for r, t in own if r == "assistant")
        assert (got[i]["n_turns"], got[i]["turns_sha256"]) == (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)))
        assert (got[i]["loss_chars"], got[i]["loss_sha256"]) == (len(said), sha(said))
