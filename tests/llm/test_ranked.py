"""Ranked search against a plain scorer, with ties, repeats, nulls, empty and long texts and clashing names."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import ranked

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = [(1, "the cat sat"), (2, "The CAT, the hat"), (3, ""), (4, None), (5, "--- ,, ..."), (6, "naïve café 東京 É"),
        (7, "the cat sat"), (7, "the cat sat"), (None, "the cat sat"), (9, "cat " * 3000 + "hat"), (10, "x\x00cat y_z"),
        (8, "the cat sat"), (-3, "the cat sat"), (12, "É é e"), *[(20 + i, f"word{i % 5} cat") for i in range(30)]]
ITEMS = [(1, "cat hat"), (1, "cat hat"), (2, "the the the cat"), (3, None), (4, ""), (5, "nothing here"), (6, "É 東京"),
         (None, "hat"), (7, "cat"), (7, "sat word3"), (8, "word1 word2 CAFÉ café Z")]


def plain(docs, items, top):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    rows = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(rows), sum(n for *_, n in rows)
    asked = {}
    for i, t in dict.fromkeys(items):
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for i, uses in asked.items():
        scored = []
        for d, tf, n in rows:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = 0
            for term, k in uses.items():
                if tf[term]:
                    df = sum(1 for _, other, _ in rows if other[term])
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += k * w * ((1_000_000_000 * tf[term]) // (1000 * tf[term] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("item_id", "score", "n", "cols", "rank")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(2) for c in ("doc_id", "term", "uses")})
    return docs, items


@pytest.mark.parametrize("options", [{}, {"pass_terms": 5, "tile_items": 2}, {"top": 3}])
def test_equal_to_a_plain_scorer(tables, options):
    docs, items = tables
    got = ranked.search(docs.repartition(4), items, **options).collect()
    assert sorted([tuple(r) for r in got], key=str) == plain(DOCS, ITEMS, options.get("top", 10))


def test_empty_tables(tables):
    docs, items = tables
    assert ranked.search(docs.where("false"), items).count() == 0
    assert ranked.search(docs, items.where("false")).count() == 0
    assert ranked.search(docs, items.where("text is null")).columns == ["item_id", "rank", "doc_id", "score"]


def test_weights_stay_exact_in_blocks():
    limit = ranked.EXACT // ranked.MAX_IMPACT
    weights = np.array([[limit * 2, 5, limit, 0], [1, 2, 3, 4]])
    blocks = ranked.weight_blocks(weights)
    assert (sum(b.astype(np.int64) for b in blocks) == weights).all() and len(blocks) > 2
    assert all((b.sum(axis=1) * ranked.MAX_IMPACT < 2 ** 53).all() for b in blocks)


def test_tile_top_keeps_ties():
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 4, (300, 7)), rng.permutation(300)
    best = ranked.Best(9, 5)
    for a in range(0, 300, 60):
        best.offer(2, scores[a:a + 60], ids[a:a + 60], np.zeros(60, bool))
    for item in range(7):
        want = sorted((-s, d) for s, d in zip(scores[:, item].tolist(), ids.tolist()) if s > 0)[:5]
        own = best.item == item + 2
        assert sorted(zip((-best.score[own]).tolist(), best.doc[own].tolist())) == want


def test_op11_on_a_table(spark, tables, tmp_path):
    docs, items = tables
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted([tuple(r) for r in ranked.op11_blas_search(spark, str(tmp_path)).collect()], key=str)
    assert got == plain(DOCS, ITEMS, 10)
