import gzip
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from newsloom.sources.catalog import (allowed_source_names, parse_catalog, parse_legacy_catalog, read_catalog, select_sources,
                                      source_lookup)
from newsloom.sources.feeds import decode_payload
from newsloom.sources.templates import ARTICLE_WEEKLY, read_templates

CATALOG = {
    "version": "2.0",
    "global": {"default_weight": 0.5, "min_score_threshold": 0.6},
    "domains": {
        "relational": {"weight": 0.8, "tags": ["SQL", " Index  ing "], "sources": [
            {"name": "Blog A", "url": "https://a.org/feed", "weight": 0.9},
            {"name": "Shared", "url": "https://s.org/feed", "weight": 0.1},
            {"url": "https://nameless.org/feed", "weight": 7}]},
        "ai_data": {"weight": 5, "tags": [], "sources": [
            {"name": "shared", "url": "https://s2.org/feed", "weight": "high"},
            {"name": "Radar", "weight": 2}]},
    },
}


def _write(obj):
    d = tempfile.mkdtemp(prefix="newsloom-test-")
    with open(os.path.join(d, "sources.json"), "w") as f:
        json.dump(obj, f, indent=2)
    return d


def test_read_catalog_order_clamp_and_lookup(spark):
    cat = read_catalog(spark, _write(CATALOG))
    rows = cat.orderBy("doc_ord", "domain_pos", "source_pos").collect()
    assert [(r.domain, r.name) for r in rows] == [("relational", "Blog A"), ("relational", "Shared"),
                                                 ("relational", None), ("ai_data", "shared"), ("ai_data", "Radar")]
    assert [r.weight for r in rows] == [0.9, 0.1, 1.0, 0.5, 0.4]
    assert rows[3].domain_weight == 1.0  # 5 -> 5/5
    lk = {r.lookup_key: r for r in source_lookup(cat).collect()}
    assert lk["shared"].domain == "ai_data" and lk["shared"].source_weight == 0.5  # last entry wins
    assert "unknown" in lk
    assert lk["blog a"].tags == ["sql", "index ing"]


def test_mode_selection(spark):
    cat = read_catalog(spark, _write(CATALOG))
    radar = select_sources(cat, " AI_Radar ").where("selected").select("name").collect()
    assert sorted(r.name for r in radar) == ["Radar", "shared"]
    names = sorted(r.source for r in allowed_source_names(select_sources(cat, "weekly")).collect())
    assert names == ["", "Blog A", "Radar", "Shared", "shared"]
    none = dict(CATALOG, domains={"x": CATALOG["domains"]["relational"]})
    sel = select_sources(read_catalog(spark, _write(none)), "ai_radar").collect()
    assert all(not r.selected and not r.filter_active for r in sel)


def test_legacy_catalog(spark):
    doc = json.dumps({"sources": {"vendors": [{"name": "V", "url": "https://v.org"}], "note": "not a list",
                                  "blogs": [{"name": "B", "url": "https://b.org"}]}})
    df = spark.createDataFrame([(0, doc)], "doc_ord int, value string")
    rows = parse_legacy_catalog(df).orderBy("domain_pos", "source_pos").collect()
    assert [(r.domain, r.name) for r in rows] == [("vendors", "V"), ("blogs", "B")]


def test_decode_payload(spark):
    text = "<rss>café ☃</rss>"
    payloads = [(0, gzip.compress(text.encode())), (1, text.encode()), (2, b"ab\xffcd"), (3, None),
                (4, b"\x1f\x8bnot gzip")]
    df = spark.createDataFrame(payloads, "i int, b binary")
    got = [r["t"] for r in df.select("i", decode_payload(F.col("b")).alias("t")).orderBy("i").collect()]
    assert got == [text, text, "abcd", None, None]


def test_read_templates(spark):
    d = tempfile.mkdtemp(prefix="newsloom-tpl-")
    with open(os.path.join(d, "article_weekly.txt"), "w", encoding="utf-8") as f:
        f.write(ARTICLE_WEEKLY)
    rows = read_templates(spark, d).collect()
    assert [(r.template_name, r.template) for r in rows] == [("article_weekly", ARTICLE_WEEKLY)]


def test_legacy_catalog_selects_all_and_filters_nothing(spark):
    doc = json.dumps({"sources": {"ai_data": [{"name": "V", "url": "https://v.org"}],
                                  "blogs": [{"name": "B", "url": "https://b.org"}]}})
    cat = parse_legacy_catalog(spark.createDataFrame([(0, doc)], "doc_ord int, value string"))
    sel = select_sources(cat, "ai_radar").collect()
    assert all(r.selected for r in sel) and not any(r.filter_active for r in sel)
    assert allowed_source_names(select_sources(cat, "weekly")).count() == 0
    assert source_lookup(cat).count() == 0


def test_catalog_level_values_hold_without_sources(spark):
    docs = spark.createDataFrame([(0, '{"global": {"default_weight": 0.9, "min_score_threshold": 0.7}, "domains": {}}')],
                                 "doc_ord int, value string")
    cat = parse_catalog(docs)
    assert [(r.kind, r.default_weight, r.min_score_threshold) for r in cat.collect()] == [("global", 0.9, 0.7)]
    assert select_sources(cat, "weekly").count() == 0 and source_lookup(cat).count() == 0


def test_broken_catalog_fails(spark):
    docs = spark.createDataFrame([(0, '{"domains": {')], "doc_ord int, value string")
    with pytest.raises(Exception, match="(?i)malformed"):
        parse_catalog(docs).collect()
