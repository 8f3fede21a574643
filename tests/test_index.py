"""Key indexes, the duplicate check by index, and a run's change set."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from newsloom.__main__ import main
from newsloom.operators.dedupe import duplicate_ids, duplicates_by_index, flag_duplicates, index_titles
from newsloom.operators.index import KeyIndex
from newsloom.operators.summary import DailyTops
from newsloom.operators.util import shared_folder
from newsloom.plans.jobs import run_mode
from newsloom.sources.catalog import parse_documents
from newsloom.sources.templates import read_templates, template_table, write_templates

from test_incremental import scan_rows

AS_OF = dt.datetime(2024, 1, 31)


def entries(spark, *rows):
    return spark.createDataFrame(rows, "key string, id long, mark long, alive boolean")


def test_latest_and_least_entries(spark):
    index = KeyIndex(spark, shared_folder(spark, "t-index"), first_buckets=4)
    assert index.buckets() == 0 and index.summary() == (0, None) and index.entries().count() == 0
    index.add(entries(spark, ("a", 1, 5, True), ("b", 2, None, True), (None, 9, None, True)), 0)
    index.add(entries(spark, ("a", 1, None, False), ("c", 3, 7, True), ("a", 8, 1, True)), 1)
    index.add(entries(spark, ("b", 2, None, False)), 2)
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,), ("a",)], "key string")
    assert sorted(map(tuple, index.latest(keys).collect())) == [("a", 8, 1), ("c", 3, 7)]
    assert sorted(map(tuple, index.latest(keys, before=1).collect())) == [("a", 1, 5), ("b", 2, None)]
    assert sorted(map(tuple, index.least(keys).collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert index.summary() == (6, 8) and index.summary(before=1) == (2, 2)
    index.add(entries(spark, ("c", 4, 7, True)), 1)  # the batch again, with other rows: they replace its own
    assert sorted(map(tuple, index.latest(keys).collect())) == [("a", 1, 5), ("c", 4, 7)]
    index.add(entries(spark), 3)
    assert index.summary() == (4, 4)


def test_a_lookup_reads_no_more_as_the_index_grows(spark):
    """Rows read for two keys stay under a bound that does not depend on the number of entries."""
    index = KeyIndex(spark, shared_folder(spark, "t-index"), first_buckets=2, bucket_rows=200)
    read = []
    for batch in range(5):
        n = 200 * 2 ** batch
        index.add(spark.range(n).select(F.concat(F.lit(f"k{batch}-"), "id").alias("key"), "id"), batch)
        found, texts = scan_rows(index.entries(spark.createDataFrame([("k0-5",), ("k0-6",)], "key string")), "key")
        read.append(found)
        assert texts and "PartitionFilters: [" in texts[0]
    assert index.buckets() >= 32 and max(read) <= 2 * 2 * 200, read
    assert index.entries().count() == sum(200 * 2 ** b for b in range(5)) == index.summary()[0]


def test_duplicates_by_index(spark):
    rows = [(i, f"Title {i % 40}" if i % 7 else None) for i in range(1, 400)] + [(500, "title 3"), (501, "New"), (502, "NEW")]
    raw = spark.createDataFrame(rows, "id long, title string")
    titles = KeyIndex(spark, shared_folder(spark, "t-titles"), first_buckets=32)
    index_titles(titles, raw.where("id < 300"), -1)
    index_titles(titles, raw.where("id >= 300"), 299)
    index_titles(titles, raw.where("id >= 300"), 299)  # a run that is made again
    assert titles.summary()[0] == 41
    every = {r["id"] for r in duplicate_ids(raw).collect()}
    assert {r["id"] for r in duplicates_by_index(raw, titles).collect()} == every
    new = raw.where("id >= 500")
    assert {r["id"] for r in duplicates_by_index(new, titles, hot_rows=1).collect()} == {500, 502}
    scored = raw.select(F.col("id").alias("raw_id"), (F.col("id") == 7).alias("is_duplicate"))
    assert sorted(map(tuple, flag_duplicates(scored, raw, titles=titles).collect())) == sorted(map(tuple, flag_duplicates(scored, raw).collect()))
    # Only the buckets of the new titles are read.
    found, _ = scan_rows(titles.entries(new.select(F.lower("title").alias("key"))), "key")
    assert 2 <= found < 20


def feed(items):
    return "<rss><channel>" + "".join(f"<item><title>{t}</title><link>{u}</link><description>{c}</description></item>"
                                      for t, u, c in items) + "</channel></rss>"


def catalog_of(spark, *names):
    sources = [{"name": n, "url": f"https://{n}/feed", "weight": 1.0} for n in names]
    return parse_documents(spark.createDataFrame([(0, json.dumps({"domains": {"d": {"weight": 1.0, "tags": ["sql"], "sources": sources}}}))],
                                                 "doc_ord int, value string"))


RAW = "id long, source string, title string, url string, published_at string, content string, ingested_at timestamp"


def test_run_with_and_without_title_index(spark):
    raw = spark.createDataFrame([(1, "s", "Old", "https://s/old", None, "sql", AS_OF), (2, "s", "Cut", "https://s/x", None, "sql", AS_OF),
                                 (3, "s", "old", "https://s/old2", None, "sql", AS_OF)], RAW)
    scored = spark.createDataFrame([(1, "g", "t", 0.9, False), (3, "g", "t", 0.95, True)],
                                   "raw_id long, db_engine string, topic string, impact_score float, is_duplicate boolean")
    payloads = spark.createDataFrame([("s", "https://s/feed", 0, feed([
        ("Cut", "https://s/x", "see https://s/x-full"), ("OLD", "https://s/new", "sql"), ("Fresh", "https://s/f", "sql"),
        ("fresh", "https://s/f2", "sql"), ("Taken", "https://s/x-full", "sql")]))],
        "source string, feed_url string, source_ord int, body string")
    links = spark.createDataFrame([("https://s/f", 200, None)], "url string, status int, error string")
    results = []
    daily = DailyTops(spark, shared_folder(spark, "t-daily"))
    for titles, tops in ((None, None), (KeyIndex(spark, shared_folder(spark, "t-titles"), first_buckets=4), daily)):
        r = run_mode(raw, scored, None, catalog_of(spark, "s"), payloads, links, "weekly", "2024-01-31", titles=titles, daily=tops)
        results.append((sorted(tuple(x) for x in r.raw.select("id", "title", "url").collect()),
                        sorted(tuple(x) for x in r.scored.collect()), sorted(tuple(x) for x in r.new_scores.collect()),
                        [tuple(x) for x in r.brief.select("article_count", "markdown").collect()], [tuple(x) for x in r.health.collect()]))
    assert results[0] == results[1]
    rows, all_scores, new, brief, _ = results[0]
    assert (2, "Cut", "https://s/x-full") in rows and [x[0] for x in rows] == [1, 2, 3, 4, 5, 6]
    assert {x[0]: x[4] for x in all_scores} == {1: False, 2: False, 3: True, 4: True, 5: False, 6: True}
    assert [x[0] for x in new] == [2, 4, 5, 6] and "https://s/x-full" in brief[0][1]


def test_run_stores_its_changes_once(spark):
    """The brief reads the stored changes: neither the feeds nor the search for rewrites is planned again."""
    raw = spark.createDataFrame([(1, "s", "Old", "https://s/old", None, "sql", AS_OF)], RAW)
    payloads = spark.createDataFrame([("s", "https://s/feed", 0, feed([("A", "https://s/a", "sql")]))],
                                     "source string, feed_url string, source_ord int, body string")
    links = spark.createDataFrame([], "url string, status int, error string")
    r = run_mode(raw, None, None, catalog_of(spark, "s"), payloads, links, "weekly", "2024-01-31")
    for df in (r.brief, r.health, r.raw, r.scored):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "new_url" not in plan or "_existing" not in plan
        assert "original_link" not in plan and "from_xml" not in plan.lower() and "xmltostructs" not in plan.lower()


def test_catalog_kinds_are_told_apart(spark):
    docs = [(0, '{"version": "2.0", "domains": {"d": {"sources": [{"name": "a", "url": "u"}]}}}'),
            (1, ' {"sources": {"c": [{"name": "b", "url": "v"}]}}'), (2, '{"domains": [1], "sources": {"c": [{"name": "x", "url": "w"}]}}'),
            (3, "{}")]
    got = parse_documents(spark.createDataFrame(docs, "doc_ord int, value string")).where("kind <> 'global'").collect()
    assert sorted((r["doc_ord"], r["kind"], r["name"]) for r in got) == [(0, "v2", "a"), (1, "legacy", "b"), (2, "legacy", "x")]


def test_templates_by_mode(spark):
    path = shared_folder(spark, "t-templates")
    write_templates(spark, {"article_weekly": "W {{articles}}", "classify_ai_radar": "R\n"}, path)
    found = read_templates(spark, path)
    modes = ["weekly", "other", "ai_radar"]
    text = lambda t, kind: {r["mode"]: r["template"] for r in template_table(spark, t, kind, modes).collect()}
    built_in = text(None, "classify")
    assert set(text(found, "article")) == set(modes) and text(found, "article")["weekly"] == text(found, "article")["other"] == "W {{articles}}"
    assert text(found, "classify") == built_in | {"ai_radar": "R\n"} and built_in["weekly"] == built_in["other"] != built_in["ai_radar"]


def test_run_from_a_legacy_catalog_templates_and_an_alternate_feed(spark):
    """The command line: a feed found only by its page's alternate link ends in a brief of the stored template."""
    root = tempfile.mkdtemp(prefix="newsloom-cli-")
    os.makedirs(f"{root}/catalog")
    with open(f"{root}/catalog/sources.json", "w") as f:
        json.dump({"sources": {"blogs": [{"name": "Blog", "url": "https://blog.org/home"}, {"name": "Late", "url": "https://late.org/x"}]}}, f)
    write_templates(spark, {"article_weekly": "Mine: {{articles}}"}, f"{root}/prompts")
    page = '<html><head><link rel="alternate" type="application/rss+xml" href="/all.xml"></head><body><br></body></html>'
    spark.createDataFrame([("https://blog.org/home", True, page, None),
                           ("https://blog.org/all.xml", True, feed([(f"Post {i}", f"https://blog.org/p/{i}", "sql") for i in range(3)]), None)],
                          "url string, ok boolean, body string, error string").write.parquet(f"{root}/answers")
    spark.createDataFrame([(f"https://blog.org/p/{i}", 200, "") for i in range(3)], "url string, status int, error string").write.parquet(f"{root}/links")
    spark.createDataFrame([(i, '{"relevance": 5, "architectural_impact": 5, "production_impact": 5}') for i in (1, 2, 3)],
                          "raw_id long, response string").write.parquet(f"{root}/responses")
    args = ["--as-of", "2024-01-31", "--catalog", f"{root}/catalog", "--answers", f"{root}/answers", "--templates", f"{root}/prompts",
            "--link-status", f"{root}/links", "--responses", f"{root}/responses", "--titles", f"{root}/titles", "--daily", f"{root}/daily",
            "--out", f"{root}/run1"]
    assert main(args) == 0
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/run1/raw").collect()) == [1, 2, 3]
    brief = spark.read.text(f"{root}/run1/briefs", wholetext=True).first()["value"]
    assert "https://blog.org/p/0" in brief
    assert [tuple(r) for r in spark.read.parquet(f"{root}/run1/requests").select("source", "url").collect()] == [("Late", "https://late.org/x")]
    assert spark.read.parquet(f"{root}/run1/scored").where("is_duplicate").count() == 0
