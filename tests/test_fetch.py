"""Fetch rounds: candidates, alternate links, pending requests, lost feeds."""

import gzip

from pyspark.sql import functions as F

from newsloom.sources.catalog import parse_catalog, parse_legacy_catalog
from newsloom.sources.fetch import fetch_rounds, selected_feeds

ANSWER = "url string, ok boolean, body binary, content_encoding string, error string"
FEEDS = "source string, feed_url string, source_ord int"


def rss(*titles):
    return "<rss><channel>" + "".join(f"<item><title>{t}</title><link>/{t}</link></item>" for t in titles) + "</channel></rss>"


def page(href):
    return f'<html><head><link rel="alternate" type="application/atom+xml" href="{href}"></head><body><p>x<br></body></html>'


def run(spark, feeds, answers, **options):
    table = spark.createDataFrame([(u, b is not None, b.encode() if isinstance(b, str) else b, e, None if b is not None else "down")
                                   for u, b, e in answers], ANSWER)
    got = fetch_rounds(spark.createDataFrame(feeds, FEEDS), table, **options)
    items = sorted((r["source"], r["round"], r["fetched_url"], r["title"]) for r in got.items.where("item_ord is not null").collect())
    pending = sorted((r["source"], r["round"], r["attempt_no"], r["url"]) for r in got.pending.collect())
    failed = sorted((r["source"], r["round"], r["url"], r["error"]) for r in got.failed.collect())
    return items, pending, failed


def test_rounds(spark):
    feeds = [("own", "https://a/feed", 0), ("cand", "https://b/feed", 1), ("alt", "https://c/x", 2), ("loop", "https://d/feed", 3),
             ("bad", "https://e/x", 4), ("lost", "https://f/x", 5), ("none", "https://g/x", 6), ("wait", "https://h/feed", 7),
             ("altwait", "https://i/x", 8), ("zip", "https://j/x", 9), ("plain", "https://k/x", 10), ("empty", "https://l/x", 11)]
    answers = [("https://a/feed", rss("A"), None), ("https://a/feed.xml", rss("never"), None),
               ("https://b/feed", None, None), ("https://b/feed.xml", None, None), ("https://b/rss", rss("B"), None),
               ("https://c/x", page("feeds/all"), None), ("https://c/feeds/all", rss("C1", "C2"), None),
               ("https://d/feed", None, None), ("https://d/feed.xml", page("/feed"), None),  # names a URL that failed before
               ("https://e/x", page("/alt"), None), ("https://e/alt", page("/other"), None), ("https://e/other", rss("third"), None),
               ("https://f/x", None, None), ("https://h/feed", None, None), ("https://i/x", page("/alt"), None),
               ("https://j/x", gzip.compress(rss("J").encode()), "gzip"), ("https://k/x", "<html><p>", None), ("https://l/x", "", None)]
    items, pending, failed = run(spark, feeds, answers)
    assert items == sorted([("own", 0, "https://a/feed", "A"), ("cand", 0, "https://b/rss", "B"), ("alt", 1, "https://c/feeds/all", "C1"),
                            ("alt", 1, "https://c/feeds/all", "C2"), ("zip", 0, "https://j/x", "J")])
    assert pending == [("altwait", 1, 0, "https://i/alt"), ("none", 0, 0, "https://g/x"), ("wait", 0, 1, "https://h/feed.xml")]
    assert failed == sorted([("loop", 0, "https://d/feed.xml", "not a feed"), ("bad", 1, "https://e/alt", "not a feed"),
                             ("lost", 0, "https://f/x", "down"), ("plain", 0, "https://k/x", "not a feed"),
                             ("empty", 0, "https://l/x", "not a feed")])
    items, _, _ = run(spark, feeds, answers, rounds=3)
    assert ("bad", 2, "https://e/other", "third") in items


def test_repeated_answers_and_feeds(spark):
    feeds = [("s1", "https://a/x", 0), ("s2", "https://a/x", 1)]  # two sources of one feed
    answers = [("https://a/x", None, None), ("https://a/x", rss("A"), None), ("https://a/x", None, None), (None, rss("B"), None)]
    items, pending, failed = run(spark, feeds, answers)
    assert [i[0] for i in items] == ["s1", "s2"] and not pending and not failed
    assert run(spark, [], answers) == ([], [], []) and run(spark, feeds, [])[1] == [
        ("s1", 0, 0, "https://a/x"), ("s2", 0, 0, "https://a/x")]


def test_text_answers(spark):
    table = spark.createDataFrame([("https://a/x", True, rss("A"))], "url string, ok boolean, body string")
    got = fetch_rounds(spark.createDataFrame([("s", "https://a/x", 0)], FEEDS), table)
    assert [(r["title"], r["link"]) for r in got.items.collect()] == [("A", "/A")]


def test_selected_feeds(spark):
    v2 = parse_catalog(spark.createDataFrame([(0, '{"domains": {"x": {"sources": [{"name": "n", "url": "u1"}, {"name": "no url"}]}, '
                                               '"ai_data": {"sources": [{"name": "m", "url": "u2"}]}}}')], "doc_ord int, value string"))
    feeds = lambda c, mode: [tuple(r) for r in selected_feeds(c, mode).orderBy("source_ord").collect()]
    assert feeds(v2, "weekly") == [("n", "u1", 0), ("m", "u2", 1)] and feeds(v2, "ai_radar") == [("m", "u2", 0)]
    old = parse_legacy_catalog(spark.createDataFrame([(0, '{"sources": {"a": [{"name": "n", "url": "u"}], "b": "no list"}}')],
                                                     "doc_ord int, value string"))
    assert feeds(old, "ai_radar") == [("n", "u", 0)] and feeds(old.where(F.lit(False)), "weekly") == []
