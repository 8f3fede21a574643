"""The training-data operators against brute force, exact round trips and held-out accuracy, on hard small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.llm import ann, ans, chat, common, embed_dedup, hnsw, minhash, mixing, packing, quality, sharding, token_counts
from newsloom.llm.common import components, shared_path
from newsloom.llm.tokenize import BYTE_BPE, PLAIN_WORD_BPE, WORD_BPE, Encoder
from newsloom.llm.vectors import units as unit_vectors

SF = "/root/testdata/sf0.001"
HARD = ["", None, "a", "One two  three\n\nfour", " lead", "tail ", "x | y|", "É̀ ΣΑΣ don't", "<|endoftext|> </turn>", "same words here now",
        "same words here now", "same words here NOW", "word " * 5000, "日本語 テキスト", "\x00 odd", "no" * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    """Hard texts, a repeated row, a null id, and columns whose names clash with the operators' own."""
    rows = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(HARD)] + [(2, "a", "s2"), (None, "no id at all", "s1")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit(1) for c in ("shard", "ids", "label", "rep", "component", "piece", "tokens")})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def library(vocabulary):
    """The tokenizers library itself, on the vocabulary's file."""
    import public_tokenizers
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(public_tokenizers.path(vocabulary.file))
    if vocabulary.plain:
        own.encode_special_tokens = True
    return own


@pytest.fixture(scope="module")
def ids_of():
    made = {v: library(v) for v in (BYTE_BPE, WORD_BPE, PLAIN_WORD_BPE)}
    return lambda v, t: made[v].encode(t or "", add_special_tokens=False).ids


SPECIAL = ["a <|endoftext|> b", "<|startoftext|>x<|endoftext|>", "A<|ENDOFTEXT|> b", "end <|endoftext|>\n\n next", "<|endoftext"]


@pytest.mark.parametrize("vocabulary", [BYTE_BPE, WORD_BPE, PLAIN_WORD_BPE])
def test_chunked_ids_equal_the_library(vocabulary, ids_of):
    own = Encoder(vocabulary)
    for texts in (HARD, HARD[::-1], SPECIAL, ["naïve, été. Ünd ßo!", "A.\nB c;", "ends.\n"]):
        ids, ends = own.texts(pa.array(texts, pa.string()))
        for text, part in zip(texts, np.split(ids, ends[:-1])):
            assert part.tolist() == ids_of(vocabulary, text)
    own.chunks = own.chunks.frequent()
    ids, _ = own.texts(pa.array(["same words here now"]))
    assert ids.tolist() == ids_of(vocabulary, "same words here now")


@pytest.mark.parametrize("vocabulary", [BYTE_BPE, WORD_BPE, PLAIN_WORD_BPE])
def test_random_texts_equal_the_library(vocabulary, ids_of):
    """Texts put together from pieces on which a cut could go wrong."""
    import random
    rng = random.Random(1)
    pieces = [" ", "  ", "\n", "\n\n", "\t", "a", "Ab", "word", "É", "é.", "ß,", "×.", "÷!", "l'été", "don't", "..", "?!", ";:", "1.5",
              "3,4", "日本。", "😀.", "x\u0301.", "\u0301", "|", " |", "<|endoftext|>", "</w>", "a.b.c", "\x00", "\u3000", "A.", "\xa0."]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    ids, ends = Encoder(vocabulary).texts(pa.array(texts).slice(3))
    for text, part in zip(texts[3:], np.split(ids, ends[:-1])):
        assert part.tolist() == ids_of(vocabulary, text), text


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(i, i + 1) for i in range(100, 140)]
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {v for p in pairs if p[0] != p[1] for v in p}}


def test_components_of_stars_take_no_step(spark, monkeypatch):
    """Links that are stars already are written, looked at once and returned; another step is made only where one is needed."""
    names = []
    monkeypatch.setattr(common, "stored", lambda s, df, name, put=common.stored: names.append(name) or put(s, df, name))
    pairs = [(7 + k % 2 * 100, 1000 + k) for k in range(30)] + [(1000, 7), (4, 4)]
    got = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: 7 + k % 2 * 100 for k in range(30) for n in (1000 + k, 7 + k % 2 * 100)}
    assert len(names) == 2
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_separator_scan(spark, docs, nothing, ids_of):
    folder = shared_path(spark, "test")
    places = token_counts.write_flat(docs.select("doc_id", "text").repartition(3), folder)
    for block in (64, 1 << 20):  # blocks much shorter than documents, and longer than files
        got = token_counts.separator_scan(spark, folder, block_bytes=block).join(places, ["file", "ordinal"])
        found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in got.where("ended").collect())
        assert found == sorted((r["doc_id"] is None, r["doc_id"] or 0, len(ids_of(PLAIN_WORD_BPE, r["text"]))) for r in docs.collect())
    folder = shared_path(spark, "test")
    assert token_counts.write_flat(nothing.select("doc_id", "text"), folder).count() == 0
    assert token_counts.separator_scan(spark, folder).count() == 0


def test_separator_scan_unended_file(spark):
    folder = shared_path(spark, "test").removeprefix("file:")
    import os
    os.makedirs(folder)
    with open(f"{folder}/a.ids", "wb") as f:
        f.write(np.array([5, 9, 9, 7, 7], "<u2").tobytes())
    got = token_counts.separator_scan(spark, folder, end_id=9, block_bytes=2).orderBy("ordinal").collect()
    assert [(r["start"], r["n_tokens"], r["ended"]) for r in got] == [(0, 1, True), (2, 0, True), (3, 2, False)]


def test_ring_is_balanced_and_moves_little(spark, docs, nothing):
    got = sharding.shard_documents(docs, 4).toPandas()
    assert sorted(got.groupby("shard").size()) == [4, 4, 5, 5]
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard").slot)
    assert got[got.doc_id == 0]["size"].tolist() == [1] and got[got.doc_id == 1].text_crc32.isna().all()
    assert sharding.shard_documents(nothing, 4).count() == 0
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    before = sharding.bounded_ring(keys, 16, slack=0.1).withColumnRenamed("shard", "was")
    after = sharding.bounded_ring(keys, 17, slack=0.1)
    assert before.groupBy("was").count().agg(F.max("count")).first()[0] <= 275
    assert before.join(after, "doc_id").where("was <> shard").count() < 0.3 * 4000


def test_mixing(spark, docs, nothing):
    rows = docs.select("doc_id", "text", "source", "tokens")
    got = mixing.mix(rows, mixing.Target(repetitions=2.0), block_tokens=500).toPandas()
    times = got.groupby(got.doc_id.fillna(-1)).size()
    assert set(times.index) == {-1, *range(len(HARD))} and (got.mix_at >= 0).all() and (got.mix_at <= 1).all()
    assert times.drop(2).max() <= 2 and list(got.columns[:4]) == ["doc_id", "text", "source", "tokens"]
    assert mixing.mix(nothing).count() == 0
    shares = spark.createDataFrame([("a", 0.7, 700), ("b", 0.2, 200), ("c", 0.1, 100)], "source string, p double, tokens long")
    a = mixing.bisect_exponent(shares, mixing.Target(repetitions=1.5))
    assert (0.7 / 0.1) ** (1 - a) == pytest.approx(1.5, abs=1e-4)
    a = mixing.bisect_exponent(shares, mixing.Target(entropy=1.0))
    w = np.array([0.7, 0.2, 0.1]) ** a
    w /= w.sum()
    assert -(w * np.log(w)).sum() == pytest.approx(1.0, abs=1e-4)
    # A budget under the corpus: no source above its budget.
    target = mixing.Target(repetitions=1.0, budget=3000)
    plan = mixing.mixture(mixing.source_tokens(rows), target, block_tokens=500).toPandas()
    assert (plan.groupby(plan.source.fillna("-")).room.sum() <= plan.groupby(plan.source.fillna("-")).budget.max()).all()


def test_rows_of_a_hot_key_are_dealt(spark):
    rows = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"),
                                    F.lit("s").alias("source"))
    assert rows.select(mixing.fine_block().alias("b")).distinct().count() > 1500
    narrow = rows.select("doc_id", F.crc32("text").alias("c"), F.xxhash64("doc_id").alias("_h"))
    assert narrow.select(sharding.part_of(("c",)).alias("p")).distinct().count() == sharding.PARTS
    got = sharding.shard_documents(rows, 4).toPandas()
    assert sorted(zip(got.shard, got.slot)) == [(s, k) for s in range(4) for k in range(500)]


def test_packing(spark, docs, nothing, ids_of):
    got = packing.pack_documents(docs, 64, group_pieces=8).toPandas()
    whole = defaultdict(list)
    for r in docs.collect():
        whole[r["doc_id"]].append(ids_of(BYTE_BPE, r["text"]) + [2])
    assert got.length.sum() == sum(len(x) for v in whole.values() for x in v) and (got.length <= 64).all()
    assert (got[got.piece > 0].length == 64).all()
    for r in got.dropna().itertuples():
        part = whole[r.doc_id][0][r.start:r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert (placed.groupby("sequence_id").length.sum() <= 64).all()
    assert packing.pack_documents(nothing).count() == 0


def test_lower_bound_and_best_fit():
    assert packing.lower_bound(np.array([6, 6, 6, 4]), 10) == 3
    assert packing.lower_bound(np.array([], int), 10) == 0
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = rng.integers(1, 100, 200)
        bins, offsets, fills = packing.best_fit_decreasing(lengths, 100)
        assert (np.bincount(bins, lengths) == fills).all() and fills.max() <= 100
        assert packing.lower_bound(lengths, 100) <= len(fills)


def test_ans_files(spark, docs, nothing, ids_of):
    rows = ans.read_ids(spark, ans.encode_documents(docs, shard_bytes=4000))
    got = ans.document_starts(rows).orderBy("start").collect()
    want = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    at = 0
    for r, w in zip(got, want, strict=True):
        ids = ids_of(WORD_BPE, w["text"]) + [1]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (w["doc_id"], at, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        at += len(ids)
    assert ans.read_ids(spark, ans.encode_documents(nothing)).count() == 0


def test_ans_coder():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(1.5, 50_000), 999)
    coder = ans.Coder(ans.frequencies(np.bincount(ids)), lanes=16, every=32)
    for n in (0, 1, 17, 50_000):
        words, states, places, steps = coder.encode(ids[:n])
        assert (coder.decode(words, states, places, steps)[:n] == ids[:n]).all()
    part = coder.decode(words, states, places, steps, first=5, checkpoints=2)
    assert (part == ids[5 * 32 * 16:7 * 32 * 16]).all()
    block = ans.encode_run(coder, 0, np.array([1]), np.array([False]), np.array([100]), ids[:100])[0]
    assert ans.decode_block(coder, block).tolist() == ids[:100].tolist()
    with pytest.raises(ValueError):
        ans.decode_block(coder, block | {"crc": block["crc"] ^ 1})


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def near_rows():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 8))
    rows = [(i, (base[i % 40] + rng.normal(scale=0.04, size=8)).astype(np.float32).tolist(), i % 2) for i in range(400)]
    rows += [(400 + i, rows[0][1], 0) for i in range(30)]  # exact copies
    return rows + [(500, None, 0), (501, [0.0] * 8, 0), (502, [float("nan")] + [1.0] * 7, 0), (503, [None] + [1.0] * 7, 0),
                   (504, rows[0][1], None), (505, [1.0], 0), (None, rows[0][1], 0), (0, rows[0][1], 0)]


def test_posting_lists_equal_brute_force(spark):
    rows = near_rows()[:-1]
    table = vectors(spark, rows)
    queries = table.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    got = ann.search(table, queries).toPandas()
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and len(v) == 8 and None not in v
            and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = total = 0
    for q in (i for i in ids if i % 50 == 0):
        s = x @ x[ids == q][0]
        want = [int(i) for i in ids[np.lexsort((ids, -np.round(s, 9)))] if i != q][:5]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(mine.score, [s[ids == i][0] for i in mine.vec_id], atol=1e-6)
        hit, total = hit + len(set(want) & set(mine.vec_id)), total + 5
    assert hit >= 0.9 * total and set(got.query_id) == {i for i in ids if i % 50 == 0}
    few = ann.search(table.where("vec_id in (0, 50, 100)"), queries).toPandas()
    assert len(few[few.query_id == 0]) == 2
    assert ann.search(table.where("false"), queries).count() == 0


def exact_neighbours(rows, queries, top=5):
    """Rows: different (id, vector); a row's score is the best over the query id's vectors."""
    items = {(i, tuple(v)) for i, v in rows}
    cos = lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b))
    want = {}
    for q in {i for i, _ in queries}:
        own = {tuple(v) for i, v in queries if i == q}
        scored = sorted((-round(max(cos(v, w) for w in own), 6), i) for i, v in items if i != q)
        want[q] = [i for _, i in scored[:top]]
    return want


def test_posting_lists_repeated_rows(spark):
    rng = np.random.default_rng(12)
    usable = [(i, v) for i, v, _ in near_rows() if i is not None and v and len(v) == 8 and None not in v
              and np.isfinite(v).all() and np.any(v)]
    far = [(700 + k, rng.normal(size=8).astype(np.float32).tolist()) for k in range(3)]
    usable += far * 6 + [(1, far[0][1]), (700, usable[1][1])]  # rows six times, ids with two vectors that cross
    centre = rng.normal(size=8)
    usable += [(800, (centre + rng.normal(scale=0.01, size=8)).astype(np.float32).tolist()) for _ in range(40)]  # one id, many vectors
    usable += [(801 + k, (centre + rng.normal(scale=0.3, size=8)).astype(np.float32).tolist()) for k in range(6)]
    table = spark.createDataFrame(usable, "vec_id long, embedding array<float>")
    asked = [(i, v) for i, v in usable if i % 50 == 0 or i in (1, 701)]
    got = ann.search(table, spark.createDataFrame(asked, "query_id long, embedding array<float>")).toPandas()
    want = exact_neighbours(usable, asked)
    assert want[0] == [400, 401, 402, 403, 404]
    hit = 0
    for q, ids in want.items():
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and q not in set(mine.vec_id)
        hit += len(set(ids) & set(mine.vec_id)) / len(set(ids))
    assert got[got.query_id == 0].sort_values("rank").vec_id.tolist() == want[0]
    assert hit >= 0.9 * len(want)


def test_vector_links_equal_brute_force(spark):
    rows = near_rows()
    for shard_rows in (4096, 40):
        got = embed_dedup.link_vectors(vectors(spark, rows), shard_rows=shard_rows).toPandas()
        assert len(got) == len(rows)
        usable = {i: (np.array(v, float), g) for i, v, g in rows if i is not None and g is not None and v and None not in v
                  and np.isfinite(v).all() and np.any(v)}
        near = {i: [j for j, (w, h) in usable.items() if j != i and g == h and len(v) == len(w)
                    and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98] for i, (v, g) in usable.items()}
        for r in got.dropna(subset=["vec_id"]).itertuples():
            assert r.n_links == len(near.get(r.vec_id, []))
            seen, todo = {r.vec_id}, [r.vec_id]
            while todo:
                todo = [j for i in todo for j in near.get(i, []) if j not in seen and not seen.add(j)]
            assert r.component_id == min(seen) and r.kept == (r.vec_id == min(seen))
    assert embed_dedup.link_vectors(vectors(spark, rows).where("false")).count() == 0


def test_every_vector_of_an_id_is_compared(spark):
    """One id with several vectors: each has its own links, and all stand in one component."""
    rng = np.random.default_rng(9)
    a, b, c, d = (rng.normal(size=8).astype(np.float32).tolist() for _ in range(4))
    rows = [(1, a, 0), (2, a, 0), (2, b, 0), (3, b, 0), (3, b, 0), (4, c, 0), (5, d, 0), (5, c, 0), (5, [0.0] * 8, 0), (6, d, 1), (7, d, None)]
    got = embed_dedup.link_vectors(vectors(spark, rows).withColumns({x: F.lit(1) for x in ("rep", "key1", "copies", "component", "low")}))
    got = sorted(map(tuple, got.collect()))
    assert got == sorted([(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 1, 1, False), (3, 1, 1, False), (4, 1, 4, True),
                          (5, 0, 4, False), (5, 1, 4, False), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True)])


def test_link_recall_on_planted_tables(spark):
    """Clusters around and under the threshold, in one shard and over many: no link is lost, none is invented."""
    for n, shard_rows in ((400, 4096), (1500, 300)):
        rng = np.random.default_rng(n)
        centres = rng.normal(size=(n // 25, 16))
        x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, 16)) * rng.choice([0.05, 0.1, 0.16], (n, 1))
        u = (x / np.linalg.norm(x, axis=1)[:, None])
        links = (u @ u.T >= 0.98).sum() - n
        got = embed_dedup.link_vectors(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]), shard_rows=shard_rows)
        found = got.agg(F.sum("n_links")).first()[0]
        assert links > 1000 and abs(found - links) <= 4  # float32 rows: pairs on the threshold itself


class Trapped(hnsw.Graph):
    """A graph whose beams end inside the cluster (all but the last point) until they are wider than it."""

    def search(self, queries, width):
        sims = queries @ self.x.T
        if width <= 600:
            sims[:, -1] = -np.inf
        ids = np.argsort(-sims, axis=1)[:, :width]
        return ids, np.take_along_axis(sims, ids, 1)


def test_links_beyond_a_near_cluster():
    rng = np.random.default_rng(4)
    c, d = np.eye(32)[:2]
    turn = lambda a: np.cos(a) * c + np.sin(a) * d
    angle = np.arccos(0.97)
    cluster = c + rng.normal(scale=0.001, size=(600, 32))  # just under the threshold from the query
    own = np.concatenate([rng.normal(size=(600, 32)), cluster, [turn(angle + np.arccos(0.985))]])
    queries = np.concatenate([rng.normal(size=(1500, 32)), [turn(angle)]])
    graph = Trapped(unit_vectors(own).astype(np.float32), [], [])
    want = unit_vectors(queries) @ unit_vectors(own).T >= 0.98
    assert want.sum() == 1
    assert (embed_dedup.audited_links(graph, own, queries, 0.98) == want).all()


def test_graph_reaches_every_point():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(900, 8)), rng.normal(size=8) * 5 + rng.normal(scale=0.01, size=(300, 8))])
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    graph = hnsw.build(x)
    reached = np.zeros(len(x), bool)
    hnsw._spread(graph.links[0], reached, graph.members[1])
    assert reached.all()
    # A beam narrower than the tight cluster can end inside it; a wider one finds every point.
    ids, _ = graph.search(x[:900], 512)
    assert (ids == np.arange(900)[:, None]).any(1).mean() > 0.99


def brute_groups(rows, width):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_groups_equal_brute_force(spark, width):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in rows] + [(10_000 + i, t) for i, t in enumerate(HARD)]
    rng = np.random.default_rng(8)
    for g in range(120):  # one group of near copies that are not all alike
        words = [f"w{k}" if rng.random() > 0.08 else f"x{rng.integers(1e9)}" for k in range(60)]
        rows.append((20_000 + g, " ".join(words)))
    table = spark.createDataFrame(rows + [(None, "a null id"), rows[0]], "doc_id long, text string")
    got = minhash.near_duplicates(table, width).toPandas()
    assert len(got) == len(rows) + 2
    want = brute_groups(rows, width)
    for r in got.dropna(subset=["doc_id"]).itertuples():
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)
    assert minhash.near_duplicates(table.where("false"), width).count() == 0


def test_minhash_of_near_copies_takes_few_shuffles(spark, monkeypatch):
    """One large group of near copies, in several components until its blocks are compared: the fixed cost of the job is
    its number of shuffles, each with as many tasks as there are partitions."""
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{i}" if rng.random() > 0.08 else f"x{rng.integers(1e9)}" for i in range(60))) for k in range(150)]
    shuffles = []

    def put(s, df, name, put=common.stored):
        shuffles.append(len(re.findall(r"(?<!Reused)Exchange (?:hash|Single|range)", df._jdf.queryExecution().executedPlan().toString())))
        return put(s, df, name)

    monkeypatch.setattr(common, "stored", put)
    monkeypatch.setattr(minhash, "stored", put)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).toPandas()
    want = brute_groups(rows, 2)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert sum(shuffles) <= 50, (sum(shuffles), shuffles)


def test_minhash_compares_every_text_of_an_id(spark):
    """A document with several texts links where any of them does; its rows are one component."""
    long = lambda seed, n=40: " ".join(f"{seed}{k}" for k in range(n))
    rows = [(1, long("a")), (2, long("a")), (2, long("b")), (3, long("b") + " more"), (4, long("c")), (5, long("d")), (5, long("e")),
            (5, long("d")), (6, long("e")), (7, None), (7, long("f")), (8, long("f")), (8, "")]
    rows += [(9, long(f"z{k}-")) for k in range(50)] + [(10, long("z49-"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("rep", "key1", "component", "n", "low")})
    got = minhash.near_duplicates(docs.repartition(3), 2).toPandas()
    assert len(got) == len(rows)
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7, 8: 7, 9: 9, 10: 9}
    assert got.groupby("doc_id").component_id.unique().map(list).to_dict() == {k: [v] for k, v in want.items()}
    assert (got.kept == (got.doc_id == got.component_id)).all()
    assert sorted(got[got.doc_id == 8].n_shingles) == [0, 39] and sorted(got[got.doc_id == 7].n_shingles) == [0, 39]


def test_quality(spark, docs, nothing):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    machine = quality.train(table, labels)
    got = quality.score(table, machine).withColumn("held", quality.held_out(F.col("doc_id"))).join(labels, "doc_id").toPandas()
    held = got[got.held]
    assert ((held.score >= 0.5) == (held.quality == 1)).mean() >= 0.95
    assert set(got[got.held].doc_id) == {d for d in got.doc_id if zlib.crc32(str(d).encode()) % 3 == 1}
    hard = quality.score(docs, machine).toPandas()
    assert hard.score.between(0, 1).all() and len(hard) == docs.count()
    assert quality.score(nothing, quality.train(nothing, labels)).count() == 0


def test_quality_of_a_repeated_document(spark):
    rows = [(k, f"text of {k}") for k in range(1, 60)]
    taught = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 != 1]
    hot = taught[0]
    table = spark.createDataFrame(rows + [(hot, f"text of {hot} again {n % 7}") for n in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows] + [(hot, hot % 2)] * 50, "doc_id long, quality int")
    seen = quality.taught(table, labels, 200).toPandas()
    assert sorted(seen.doc_id) == taught
    again = quality.taught(table.repartition(5), labels, 200).toPandas()
    assert again.sort_values("doc_id").value.tolist() == seen.sort_values("doc_id").value.tolist()


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(9)
    m = quality.Machine(0.3, rng.normal(size=quality.BUCKETS + quality.DENSE), rng.normal(size=(quality.BUCKETS + quality.DENSE, 4)))
    at, x = np.array([3, 77, 500, 9000]), rng.normal(size=4)
    slow = 0.3 + sum(m.weights[i] * v for i, v in zip(at, x)) + sum(
        m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert m.raw(at, x) == pytest.approx(slow)


def test_reply_trees(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", "good", 0.9),
            ("t", 4, 3, "user", "thanks", 0.5), ("u", 1, 99, None, None, None), ("c", 1, 2, "user", "x", 1.0), ("c", 2, 1, "user", "y", 1.0),
            ("c", 3, 2, "user", "hangs on the cycle", 1.0)]
    nodes = spark.createDataFrame(rows, "tree string, node int, parent int, role string, text string, score double")
    walk = chat.paths(nodes)
    assert sorted(map(tuple, walk.select("tree", "leaf", "node", "up").collect())) == [
        ("t", 2, 1, 1), ("t", 2, 2, 0), ("t", 4, 1, 2), ("t", 4, 3, 1), ("t", 4, 4, 0), ("u", 1, 1, 0)]
    best = {r["tree"]: r for r in chat.format_paths(nodes).collect()}
    assert best["t"]["formatted"] == "### user: q </turn>\n### assistant: good </turn>\n### user: thanks </turn>\n"
    assert [(s["begin"], s["length"]) for s in best["t"]["loss"]] == [(35, 4)]
    assert best["t"]["formatted"][35:39] == "good"
    assert chat.format_paths(nodes, per_tree=None).count() == 3


def test_conversations_round_trip(spark):
    texts = ["", None, "\\### Assistant: </turn> ok", "a\\h#<:\\\\", " </turn>\n### user: x", "plain 😀"]
    rows = [(c, t, "assistant" if t % 2 else "user", texts[(c + t) % len(texts)]) for c in range(6) for t in range(c + 1)]
    rows += [(7, t, "user", str(t)) for t in range(130)] + [(8, 0, "r:#", "b"), (8, 0, "assistant", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit(3))
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(turns)).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((t, r, x or "") for k, t, r, x in rows if k == c)
        listed = "".join(f"{r}\n{x}\n" for _, r, x in own)
        said = "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["turns_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(said) and got[c]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert chat.format_conversations(turns.where("false")).count() == 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as pipeline
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    kept = pipeline.dedup_stage(spark, rows, SF)
    groups = brute_groups([(r["doc_id"], r["text"]) for r in rows.collect()], 5)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({g for _, g in groups.values()})
    mixed = pipeline.mixing_stage(spark, kept, SF)
    assert mixed.columns == rows.columns and {r[0] for r in mixed.select("doc_id").collect()} == {r[0] for r in kept.select("doc_id").collect()}
    good = pipeline.quality_stage(spark, rows, SF)
    assert good.columns == rows.columns and 0 < good.count() <= rows.count()
    got = pipeline.run(spark, SF)
    assert got.count() and got.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
    assert pipeline.dedup_stage(spark, docs, SF).select("doc_id").distinct().count() == len(HARD) + 1 - 2


def test_dedup_compares_every_row(spark):
    import corpus_pipeline as pipeline
    text = lambda k: " ".join(f"w{k}x{n}" for n in range(40))
    rows = [(1, text(1)), (1, text(2)), (1, text(3)),  # one id, three texts, none of them copies
            (0, text(2)),  # the second's copy under a smaller id
            (5, text(3) + " end"),  # near the third, under a greater id
            (6, text(6)), (6, text(6)), (None, text(7)), (None, text(7)), (None, text(6)), (None, text(8)),
            (8, ""), (8, ""), (8, None), (None, None), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = sorted(map(repr, pipeline.dedup_stage(spark, table, SF).select("doc_id", "text").toPandas().astype(object).where(
        lambda x: x.notna(), None).itertuples(index=False, name=None)))
    want = [(1, text(1)), (0, text(2)), (1, text(3)), (6, text(6)), (None, text(7)), (None, text(8)), (8, ""), (8, None),
            (None, None), (None, None)]
    shape = lambda i, x: repr((None if i is None else float(i), x))
    assert got == sorted(shape(*r) for r in want)


def test_pipeline_batches_bounded(spark, monkeypatch):
    """Long texts come to the workers in bounded batches, all of them; a bound that the session sets stays."""
    import corpus_pipeline as pipeline
    table = spark.range(40).selectExpr("id as doc_id", "repeat('a b', 100000) as text", "'s' as source").coalesce(1)
    found = []

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(b)], "size": [b.nbytes]})

    def seen(docs):
        found.append(docs.mapInArrow(sizes, "n long, size long").collect())
        return docs.withColumn("mix_at", F.lit(0.0))

    monkeypatch.setattr(pipeline.mixing, "mix", seen)
    spark.conf.unset(common._BATCH_SETTING)
    try:
        assert pipeline.mixing_stage(spark, table, SF).count() == 40
        spark.conf.set(common._BATCH_SETTING, str(1 << 20))
        pipeline.mixing_stage(spark, table, SF)
        assert spark.conf.get(common._BATCH_SETTING) == str(1 << 20)
    finally:
        spark.conf.unset(common._BATCH_SETTING)
    for rows, most in zip(found, (common.BATCH_BYTES, 1 << 20)):
        assert sum(r.n for r in rows) == 40
        assert max(r.size for r in rows) <= most + 400_000  # a batch ends with the row that reaches the bound
