"""Packing and mixing against plain versions, and the token queries by their registered parameters."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import ans, mixing, packing
from newsloom.llm.tokenize import BYTE_BPE, WORD_BPE

from .test_llm import SPECIAL, library

LENGTHS = [5, 60, 33, 31, 64, 1, 20, 44, 12, 52, 64, 8, 8, 8, 40]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A folder with a documents table: special strings, empty, null and long texts, repeated rows, a hot source."""
    folder = str(tmp_path_factory.mktemp("sf"))
    texts = [*SPECIAL, "", None, "word " * 3000, "same text here", "same text here"] + [f"plain words {i} and more" for i in range(40)]
    rows = [(i if i != 9 else 8, t, "hot" if i % 3 else f"s{i % 2}", "en", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(
        f"{folder}/documents.parquet")
    return folder, rows


def plain_best_fit(lengths, capacity):
    """Bins of a best-fit-decreasing packer that looks at every bin."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [k for k, r in enumerate(rooms) if r >= x]
        if fit:
            rooms[min(fit, key=lambda k: rooms[k])] -= x
        else:
            rooms.append(capacity - x)
    return len(rooms)


def test_groups_equal_a_plain_packer(spark):
    rng = np.random.default_rng(5)
    lengths = [int(x) for x in rng.integers(1, 100, 500)]
    assert len(packing.best_fit_decreasing(np.array(lengths), 100)[2]) == plain_best_fit(lengths, 100)
    items = spark.createDataFrame([(i, 0, 0, x, i) for i, x in enumerate(lengths)],
                                  "doc_id long, piece int, start long, length long, ids_crc32 long")
    for pieces in (1000, 60):  # one group; many groups whose unfilled bins are exchanged
        got = packing.pack(items, 100, group_pieces=pieces).toPandas()
        assert sorted(got.doc_id) == list(range(500))
        bins = got.groupby("sequence_id").length.sum()
        assert bins.max() <= 100 and packing.lower_bound(np.array(lengths), 100) <= len(bins)
        extra = len(bins) - plain_best_fit(lengths, 100)
        assert extra <= (0 if pieces == 1000 else 2 * 9)  # a group of 60 pieces may waste up to two bins
        placed = got.sort_values(["sequence_id", "offset"])
        assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()


def test_packing_along_an_order(spark, monkeypatch):
    """Neighbours share sequences, but for the pieces of bins that the groups could not fill."""
    monkeypatch.setattr(packing, "ORDER_BITS", 5)
    docs = spark.createDataFrame([(i, "word " * (1 + i * 7 % 23), 10 + i) for i in range(320)], "doc_id long, text string, place long")
    got = packing.pack_documents(docs.repartition(4), 64, order="place", group_pieces=64).toPandas()
    assert sorted(got.doc_id) == list(range(320)) and got.groupby("sequence_id").length.sum().max() <= 64
    first = got[got.sequence_id < 1 << 56]  # packed in the first round
    spans = first.assign(part=(first.doc_id + 10) // 32).groupby("sequence_id").part.nunique()
    assert len(first) > 160 and spans.max() == 1
    by = first.assign(part=(first.doc_id + 10) // 32).sort_values("sequence_id")
    assert by.part.is_monotonic_increasing
    plain = packing.pack_documents(docs, 64).toPandas()
    assert got.sequence_id.nunique() <= plain.sequence_id.nunique() + 6  # ten groups of 32 pieces waste a little


def test_mixture_order(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "ab"[i % 4 == 0]) for i in range(400)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs, block_tokens=200)
    rows = mixing.in_mixture_order(mixed).withColumn("p", F.spark_partition_id()).toPandas()
    assert len(rows) == mixed.count() and rows.mix_at.is_monotonic_increasing
    share = (rows.source == "b").rolling(100).mean().dropna()
    assert share.max() - share.min() < 0.35  # sources interleave all along


def test_op4_ids_are_the_library_s(spark, table):
    folder, rows = table
    own = library(BYTE_BPE)
    want = sorted((i, zlib.crc32(np.array(own.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
                  for i, t, *_ in rows if len(t or "") < 2000)
    got = packing.op4_best_fit_packing(spark, folder).toPandas()
    short = got[got.doc_id != 7]  # all but the long text
    assert (short.piece == 0).all() and sorted(zip(short.doc_id.tolist(), short.ids_crc32.tolist())) == want
    assert got.groupby("sequence_id").length.sum().max() <= 1024


def test_op7_ids_are_the_library_s(spark, table):
    folder, rows = table
    own = library(WORD_BPE)
    at = 0
    got = ans.op7_token_ans(spark, folder).orderBy("start").collect()
    for r, (i, t, *_) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] or "")), strict=True):
        ids = own.encode(t or "", add_special_tokens=False).ids + [1]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_op3_uses_every_document(spark, table):
    folder, rows = table
    got = mixing.op3_temperature_mix(spark, folder).toPandas()
    assert set(got.doc_id) == {r[0] for r in rows} and got.mix_at.between(0, 1).all()
    assert got.groupby(["doc_id", "source"]).epoch.nunique().max() <= 2


def test_mixture_equals_a_plain_version(spark):
    """The rows of each epoch, from the definition: whole blocks in order, and at the edge those that fit."""
    rows = [(i, f"text {i} " * (1 + i % 7), "abc"[min(i % 10, 2)]) for i in range(120)]
    rows += [rows[3]] * 4  # repeated rows, all or none
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = mixing.Target(repetitions=1.5, budget=700)
    got = mixing.mix(docs, target, block_tokens=100).toPandas()
    keyed = docs.select("doc_id", "source", "text", mixing.row_key().alias("key"), mixing.fine_block().alias("fine")).toPandas()
    own = library(BYTE_BPE)
    keyed["n"] = [len(own.encode(t, add_special_tokens=False).ids) + 1 for t in keyed.text]
    shares = keyed.groupby("source").n.sum()
    p = shares / shares.sum()
    lo, hi = 0.0, 1.0
    for _ in range(60):  # the least exponent at which no source is used more than 1.5 times
        a = (lo + hi) / 2
        w = p ** a / (p ** a).sum()
        lo, hi = (lo, a) if (w * 700 / shares).max() <= 1.5 else (a, hi)
    w = p ** hi / (p ** hi).sum()
    plan = mixing.mixture(mixing.source_tokens(docs), target, block_tokens=100).toPandas()
    assert plan.groupby("source").budget.first().to_dict() == pytest.approx((w * 700).round().to_dict(), abs=1)
    turns = {(r["e"], r["key"]): r["t"] for r in docs.select(mixing.row_key().alias("key")).distinct().join(
        spark.range(3).select(F.col("id").cast("int").alias("e"))).select(
        "e", "key", F.xxhash64(F.lit(0), "e", "key").alias("t")).collect()}
    want = defaultdict(int)
    for b in plan.itertuples():
        part = keyed[(keyed.source == b.source) & (keyed.fine % b.n_blocks == b.block)]
        assert part.n.sum() == b.tokens
        total = 0
        groups = sorted(part.groupby("key"), key=lambda kv: (turns[b.epoch, kv[0]], kv[0]))
        for _, g in groups:
            total += g.n.sum()
            if total <= b.room:
                for d in g.doc_id:
                    want[int(d), b.source, int(b.epoch)] += 1
    have = got.groupby(["doc_id", "source", "mix_epoch"]).size().to_dict()
    assert {(int(a), b, int(c)): n for (a, b, c), n in have.items()} == dict(want)
