from urllib.parse import urljoin

from pyspark.sql import functions as F

from conftest import one
from newsloom.functions.text import (canonical_url, extract_urls, markdown_urls, normalize_text, repair_link,
                                     resolve_url)


def test_normalize_unicode_whitespace(spark):
    vals = [None, "", "  a\tb\nc  ", "a b", "a  b", "a\x1cb", "x \r\n y"]
    assert one(spark, normalize_text, vals) == ["", "", "a b c", "a b", "a b", "a b", "x y"]


def test_canonical_url(spark):
    vals = ["https://dba.stackexchange.com/questions/123/some-slug?x=1",
            "HTTPS://DBA.StackExchange.com/questions/77",
            "https://dba.stackexchange.com/questions/abc",
            "https://example.org/a?b", None, ""]
    assert one(spark, canonical_url, vals) == [
        "https://dba.stackexchange.com/questions/123/", "HTTPS://DBA.StackExchange.com/questions/77/",
        "https://dba.stackexchange.com/questions/abc", "https://example.org/a?b", None, ""]


def test_extract_urls_order_and_distinct(spark):
    text = 'see https://b.org/x and <a HREF="https://a.org/1">a</a> then https://b.org/x again'
    assert one(spark, extract_urls, [text, None]) == [["https://a.org/1", "https://b.org/x"], []]


def test_markdown_urls_keep_trailing_punctuation(spark):
    md = "- t (https://a.org/1) see https://a.org/2, and https://a.org/3. https://a.org/1"
    assert one(spark, markdown_urls, [md]) == [["https://a.org/1", "https://a.org/2,", "https://a.org/3."]]


def _repair(spark, link, content):
    df = spark.createDataFrame([(link, content)], "l string, c string")
    return df.select(repair_link(F.col("l"), F.col("c")).alias("o")).first()["o"]


def test_repair_link_cases(spark):
    assert _repair(spark, "https://a.org/x", "https://a.org/x and https://a.org/xy") == "https://a.org/x"
    assert _repair(spark, "https://a.org/x", '<a href="https://a.org/x?id=1">') == "https://a.org/x?id=1"
    assert _repair(spark, "https://a.org/x", "https://a.org/x1 https://a.org/x2") == "https://a.org/x"
    # two spellings of one question canonicalise to the same URL but still count twice
    two = "https://dba.stackexchange.com/questions/5/a https://dba.stackexchange.com/questions/5/b"
    assert _repair(spark, "https://dba.stackexchange.com/questions", two) == "https://dba.stackexchange.com/questions"
    assert _repair(spark, "", "only https://a.org/one") == "https://a.org/one"
    assert _repair(spark, None, "https://a.org/one") is None
    assert _repair(spark, "https://a.org/q", None) == "https://a.org/q"


def test_resolve_url_matches_urljoin(spark):
    bases = ["http://h.example.com/fr/825?page=2&ref=x", "https://m.h.example.net/en/25#top",
             "https://h.example.org/en/853/", "https://h.example.org", "http://a/b/c/d;p?q"]
    links = ["/The", "the,", "../x", "./y/../z", "?q=1", "#frag", "//other.org/p", "g/", "..", ".", "a/./b/../c",
             "/a/../../b", "mailto:x@y", "\n  https://o.org/x\n", " /path", "/a\tb", "\x01rel/x", "///a/b", "//", "///"]
    pairs = [(b, l) for b in bases for l in links]
    df = spark.createDataFrame(pairs, "b string, l string")
    got = [r["o"] for r in df.select(resolve_url(F.col("b"), F.col("l")).alias("o")).collect()]
    want = [urljoin(b, l) for b, l in pairs]
    bad = [(p, g, w) for p, g, w in zip(pairs, got, want) if g != w and ";" not in p[0]]
    assert not bad, bad[:5]
