"""Feed payloads: decode, parse RSS/Atom (with one repair pass), pick the fetch result, feed URL discovery."""

from __future__ import annotations

import gzip
import re
import zlib
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import bind
from ..functions.text import resolve_url

# Fixed values that must equal the reference's behaviour.
FEED_SUFFIXES = ("/feed", "/rss", "/rss.xml", "/feed.xml", "/atom.xml", "/index.xml")
FEED_ALTERNATIVES = ("/feed", "/feed.xml", "/rss", "/rss.xml", "/atom.xml", "/index.xml")
ATOM_NS = "http://www.w3.org/2005/Atom"
KEPT_ENTITIES = r"&(?!amp;|lt;|gt;|quot;|apos;|#\d+;|#x[0-9A-Fa-f]+;)[A-Za-z0-9]+;"
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
ALTERNATE_LINK = r"""(?i)<link[^>]+rel=["'][^"']*alternate[^"']*["'][^>]*>"""
LINK_TYPE = r"""(?i)type=["']([^"']+)["']"""
LINK_HREF = r"""(?i)href=["']([^"']+)["']"""

# Arrays, as an element may occur more than once (the first counts); prefixed Atom fields stand in for missing ones.
_ITEM = ("title: ARRAY<STRING>, link: ARRAY<STRING>, pubDate: ARRAY<STRING>, description: ARRAY<STRING>, "
         "`atom:title`: ARRAY<STRING>, `atom:link`: ARRAY<STRUCT<_VALUE: STRING, _href: STRING>>, "
         "`atom:published`: ARRAY<STRING>, `atom:summary`: ARRAY<STRING>")
_ENTRY = ("title: STRING, link: ARRAY<STRUCT<_VALUE: STRING, _href: STRING>>, published: STRING, summary: STRING, "
          "pubDate: STRING, description: STRING")
FEED_SCHEMA = (f"channel ARRAY<STRUCT<item: ARRAY<STRUCT<{_ITEM}>>>>, item ARRAY<STRUCT<{_ITEM}>>, "
               f"entry ARRAY<STRUCT<{_ENTRY}>>, _corrupt_record STRING")
DECLARED_BYTES = rb"""<\?xml\s[^>]{0,200}?encoding\s*=\s*["']([A-Za-z][A-Za-z0-9._-]*)["']"""
DECLARED_OTHER = r"""\A<\?xml\s[^>]{0,200}?encoding\s*=\s*["'](?!(?i:utf-?8)["'])"""
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": "_corrupt_record"}


# ---- A4 payload decoding ------------------------------------------------------------------

@pandas_udf(StringType())
def _inflate_and_decode(body: pd.Series) -> pd.Series:
    """gunzip when the payload starts with the gzip magic, then decode by byte-order mark or XML declaration; where
    there is none, or the bytes don't fit it, UTF-8 with invalid bytes dropped."""
    def one(b):
        if b is None:
            return None
        b = bytes(b)
        if b[:2] == b"\x1f\x8b":
            try:
                b = gzip.decompress(b)
            except (OSError, EOFError, zlib.error):
                return None
        if b[:3] == b"\xef\xbb\xbf":
            return b[3:].decode("utf-8", errors="ignore")
        codec = {b"\xff\xfe": "utf-16", b"\xfe\xff": "utf-16", b"<\x00": "utf-16-le", b"\x00<": "utf-16-be"}.get(b[:2])
        if codec is None and (declared := re.match(DECLARED_BYTES, b)):
            codec = declared.group(1).decode("ascii")
            if codec.lower().startswith(("utf-16", "utf16", "utf-32", "utf32", "ucs")):
                codec = None  # a declaration that reads as ASCII isn't in such an encoding
        if codec:
            try:
                return b.decode(codec)
            except (LookupError, ValueError):
                pass
        return b.decode("utf-8", errors="ignore")
    return body.map(one)


def decode_payload(body: Column, content_encoding: Column | None = None) -> Column:
    """Payload bytes -> text, by byte-order mark or declared encoding, else UTF-8. Plain valid UTF-8 stays in the JVM;
    only gzip (magic bytes or a gzip Content-Encoding), invalid UTF-8 and other encodings are sent, in Arrow batches,
    to Python."""
    text = body.cast("string")
    gz = F.substring(body, 1, 2) == F.unhex(F.lit("1F8B"))
    if content_encoding is not None:
        gz = gz | (F.lower(content_encoding) == "gzip")
    other = text.rlike(DECLARED_OTHER) | text.rlike(r"\A(?:<\x00|\x00<)")
    slow = F.coalesce(gz | ~F.is_valid_utf8(text) | other, F.lit(False))
    plain = F.when(text.startswith("\ufeff"), F.substr(text, F.lit(2))).otherwise(text)
    return F.when(slow, _inflate_and_decode(F.when(slow, body))).otherwise(plain)


# ---- A5/A6 parsing ------------------------------------------------------------------------

def repair_xml(text: Column) -> Column:
    """Second-chance cleanup: cut text before the first '<', '&nbsp;' -> ' ', drop control
    characters, unknown named entities -> ' ' (amp/lt/gt/quot/apos and numeric ones kept)."""
    first = F.instr(text, "<")
    cut = F.when(first > 1, F.substr(text, first)).otherwise(text)
    t = F.replace(cut, F.lit("&nbsp;"), F.lit(" "))
    t = F.regexp_replace(t, CONTROL_CHARS, "")
    return F.regexp_replace(t, KEPT_ENTITIES, " ")


def _root_default_ns(text: Column) -> Column:
    # The root follows any byte-order mark, declaration, comments and DOCTYPE, which may hold tags of their own.
    root = F.regexp_replace(text, r"(?s)\A(?:\s|\x{FEFF}|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>)+", "")
    attrs = F.regexp_extract(root, r"<[A-Za-z_][^\s>/]*((?:\s[^>]*)?)>", 1)
    return F.regexp_extract(attrs, r"""\sxmlns\s*=\s*["']([^"']*)["']""", 1)


# What one schema of three fixed places can't read: markup or comments inside a field, and other prefixes of Atom fields.
INNER_MARKUP = r"<(?:title|link|pubDate|description|published|summary)(?:\s[^>]*)?>[^<]*<(?!/|!\[CDATA\[)"
PREFIXED_ATOM = (r"<atom:entry[\s/>]|\sxmlns:(?!atom[\s=])[\w.-]+\s*=\s*[\"']" + ATOM_NS.replace(".", r"\.") + r"[\"']"
                 r"|\sxmlns:atom\s*=\s*[\"'](?!" + ATOM_NS.replace(".", r"\.") + r"[\"'])")
# A field's element, and the Atom element (and its attribute) that stands in for a missing one.
FIELDS = (("title", "title", "title", None), ("link", "link", "link", "href"), ("published", "pubDate", "published", None),
          ("content", "description", "summary", None))


def _field(item: ElementTree.Element, plain: str, atom: str, attribute: str | None) -> str | None:
    """Text before the first child of the item's first such element (None if it is empty), '' without one."""
    if (own := item.find(plain)) is not None:
        return own.text
    if (own := item.find(f"{{{ATOM_NS}}}{atom}")) is None:
        return ""
    return own.get(attribute, "") if attribute else own.text


@pandas_udf(ArrayType(StructType([StructField(name, StringType()) for name, *_ in FIELDS])))
def _walk_items(text: pd.Series) -> pd.Series:
    """Items of well-formed feeds at any depth, in document order: ``item`` elements, else ``entry`` elements, else the
    root's own Atom entries. Null where the text isn't well-formed for this parser."""
    def one(t):
        if t is None:
            return None
        try:
            root = ElementTree.fromstring(t)
        except (ElementTree.ParseError, ValueError):
            return None
        below = [e for e in root.iter() if e is not root]
        found = ([e for e in below if e.tag == "item"] or [e for e in below if e.tag == "entry"]
                 or [e for e in root if e.tag == f"{{{ATOM_NS}}}entry"])
        return [{name: _field(e, *where) for name, *where in FIELDS} for e in found]
    return text.map(one)


def _beyond_schema(text: Column, ns: Column, items: Column, entries: Column) -> Column:
    """Whether a feed has what the fixed schema misses: items elsewhere than in a channel or under the root, markup
    inside a field, default namespaces below the root, or prefixed Atom entries."""
    def tags(name: str) -> Column:
        return F.regexp_count(text, F.lit(rf"<{name}[\s/>]"))
    deep = (tags("item") != F.size(items)) | ((F.size(items) == 0) & (tags("entry") != F.size(entries)))
    spaces = F.regexp_count(text, F.lit(r"\sxmlns\s*=")) > F.when(ns != "", 1).otherwise(0)
    return ((ns == "") & deep) | text.rlike(INNER_MARKUP) | spaces | text.rlike(PREFIXED_ATOM)


def _ref_text(v: Column) -> Column:
    """Spark gives NULL for a missing element and '' for an empty one; the reference the reverse."""
    return F.when(v.isNull(), F.lit("")).when(v == "", F.lit(None).cast("string")).otherwise(v)


def _first_text(values: Column, fallback: Column | None = None) -> Column:
    """Text of the first such element: '' when there is none (nor a fallback), NULL when it is empty."""
    none = values.isNull() | (F.size(values) == 0)
    first = F.get(values, F.lit(0))
    text = F.when(F.coalesce(first, F.lit("")) == "", F.lit(None).cast("string")).otherwise(first)
    return F.when(none, F.lit("") if fallback is None else fallback).otherwise(text)


def _rss_row(i: Column) -> Column:
    links = i["atom:link"]
    href = F.when(F.coalesce(F.size(links), F.lit(0)) > 0, F.coalesce(F.get(links, F.lit(0))["_href"], F.lit(""))).otherwise(F.lit(""))
    return F.struct(_first_text(i["title"], _first_text(i["atom:title"])).alias("title"),
                    _first_text(i["link"], href).alias("link"),
                    _first_text(i["pubDate"], _first_text(i["atom:published"])).alias("published"),
                    _first_text(i["description"], _first_text(i["atom:summary"])).alias("content"))


def parse_feed(payloads: DataFrame, text_col: str = "text", with_alternate: bool = False) -> DataFrame:
    """Feed text -> one row per item: (..., item_ord, title, link, published, content) and a
    per-feed status column ``parse_status`` ('ok' / 'repaired' / 'rejected').

    RSS ``item`` elements at any depth come first, with the first of repeated elements, their text before any child,
    and Atom elements where theirs are missing; without them, entries
    of an Atom feed (link = first link's href, published, summary); entries of a
    feed without the Atom namespace read the link text. A feed whose root declares
    another default namespace (RSS 1.0) yields no items. A malformed feed gets one
    :func:`repair_xml` pass; if that fails too it is rejected (no items); ``with_alternate`` then adds
    ``alternate_url``, the alternate feed linked in its HTML (NULL for all other rows).

    Feeds are read by one fixed schema in the JVM. Only those that hold something it can't see
    (:func:`_beyond_schema`) go, in Arrow batches, to a tree parser.
    """
    t = F.col(text_col)
    # The strict parse is its own column: it is read twice below and parsed once.
    df = payloads.withColumn("_first", F.from_xml(t, FEED_SCHEMA, XML_OPTIONS))
    df = df.withColumn("_bad", F.col("_first").isNull() | F.col("_first._corrupt_record").isNotNull())
    df = df.withColumn("_text", F.when(F.col("_bad"), repair_xml(t)).otherwise(t))
    df = df.withColumn("_x", F.when(F.col("_bad"), F.from_xml(F.col("_text"), FEED_SCHEMA, XML_OPTIONS))
                       .otherwise(F.col("_first"))).drop("_first")
    rejected = F.col("_x").isNull() | F.col("_x._corrupt_record").isNotNull()
    status = F.when(rejected, "rejected").when(F.col("_bad"), "repaired").otherwise("ok")
    ns = _root_default_ns(F.col("_text"))
    empty_items = F.array().cast(f"array<struct<{_ITEM}>>")
    in_channels = F.flatten(F.transform(F.col("_x.channel"), lambda c: F.coalesce(c["item"], empty_items)))
    rss = F.concat(F.coalesce(F.col("_x.item"), empty_items), F.coalesce(in_channels, empty_items))
    rss_rows = F.transform(rss, _rss_row)
    entries = F.coalesce(F.col("_x.entry"), F.array().cast(f"array<struct<{_ENTRY}>>"))
    atom = ns == ATOM_NS

    def entry_row(e: Column, namespaced: Column) -> Column:
        first_link = e["link"][0]
        link = F.when(namespaced, F.when(e["link"].isNull() | (F.size(e["link"]) == 0), F.lit(""))
                      .otherwise(F.coalesce(first_link["_href"], F.lit(""))))\
            .otherwise(F.when(first_link.isNull(), F.lit(""))
                       .when(F.coalesce(first_link["_VALUE"], F.lit("")) == "", F.lit(None).cast("string"))
                       .otherwise(first_link["_VALUE"]))
        pub = F.when(namespaced, _ref_text(e["published"])).otherwise(_ref_text(e["pubDate"]))
        desc = F.when(namespaced, _ref_text(e["summary"])).otherwise(_ref_text(e["description"]))
        return F.struct(_ref_text(e["title"]).alias("title"), link.alias("link"), pub.alias("published"),
                        desc.alias("content"))

    entry_rows = F.transform(entries, lambda e: entry_row(e, atom))
    plain = (F.when(rejected, F.array()).when(ns != "", F.when(atom, entry_rows).otherwise(F.array()))
             .when(F.size(rss_rows) > 0, rss_rows).otherwise(entry_rows))
    df = df.withColumn("_items", plain).withColumn("parse_status", status)
    walk = ~rejected & _beyond_schema(F.col("_text"), ns, rss, entries)
    df = df.withColumn("_walked", F.when(walk, F.col("_text")))
    df = df.withColumn("_items", F.coalesce(_walk_items("_walked"), F.col("_items")))
    keep = [c for c in payloads.columns if c != text_col]
    more = []
    if with_alternate:
        more = ["alternate_url"]
        df = df.withColumn("alternate_url", F.when(F.col("parse_status") == "rejected", alternate_feed_url(t, F.col("feed_url"))))
    return df.select(*keep, *more, "parse_status", F.posexplode_outer("_items").alias("item_ord", "it")) \
        .select(*keep, *more, "parse_status", "item_ord", "it.title", "it.link", "it.published", "it.content")


# ---- A7 fetch resolution, A8 candidates, A9 alternate feed ------------------------------------

def resolve_fetch(attempts: DataFrame, keys=("source", "feed_url")) -> DataFrame:
    """Per feed: the first successful attempt (by ``attempt_no``), else the first error."""
    k = list(keys)
    ok_order = F.when(F.col("ok"), F.col("attempt_no"))
    err_order = F.when(~F.col("ok"), F.col("attempt_no"))
    agg = attempts.groupBy(*k).agg(
        F.min_by(F.struct("attempt_no", "url", "body"), ok_order).alias("hit"),
        F.min_by(F.struct("url", "error"), err_order).alias("miss"),
        F.count_if(F.col("ok")).alias("_oks"),
        F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("attempt_no", "url")))).alias("_failed"))
    # The feed URL plus every candidate that failed before the first success (at most a few per feed).
    before_hit = F.filter("_failed", lambda x: F.coalesce(x["attempt_no"] < F.col("hit.attempt_no"), F.lit(True)))
    tried = F.array_distinct(F.concat(F.array(F.col(keys[-1])), F.transform(before_hit, lambda x: x["url"])))
    return agg.select(*k, F.when(F.col("_oks") > 0, F.col("hit.url")).alias("fetched_url"),
                      F.when(F.col("_oks") > 0, F.col("hit.attempt_no")).alias("attempt_no"),
                      F.when(F.col("_oks") > 0, F.col("hit.body")).alias("body"),
                      F.when(F.col("_oks") == 0, F.col("miss.url")).alias("error_url"),
                      F.when(F.col("_oks") == 0, F.col("miss.error")).alias("error"),
                      tried.alias("tried_urls"))


_URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def candidate_feed_urls(url) -> Column:
    """Other common feed paths at the same base: ``.../feed`` -> ``.../feed.xml``, ``.../rss`` ...

    Only when the path (trailing '/' stripped) ends with a known feed suffix; the
    query is cleared, the fragment kept, the original path itself skipped, and
    duplicates dropped in order. Any other path gives an empty array.
    """
    u = F.col(url) if isinstance(url, str) else url
    scheme, net, path, frag = (F.regexp_extract(u, _URL_PARTS, i) for i in (1, 2, 3, 5))
    has_frag = u.rlike("#") & (frag != "")
    stripped = F.regexp_replace(path, "/+$", "")
    suffix_re = "(" + "|".join(s.replace(".", r"\.") for s in FEED_SUFFIXES) + ")$"
    suffix = F.regexp_extract(stripped, suffix_re, 1)
    base = F.substring(stripped, 1, F.length(stripped) - F.length(suffix))
    base = F.when(base == "", F.lit("/")).otherwise(base)
    prefix = F.concat(F.lower(scheme), F.lit("://"), net)
    tail = F.when(has_frag, F.concat(F.lit("#"), frag)).otherwise(F.lit(""))
    alts = F.array(*[F.lit(a) for a in FEED_ALTERNATIVES])
    new_paths = F.transform(alts, lambda a: F.when(base != "/", F.concat(F.regexp_replace(base, "/+$", ""), a))
                            .otherwise(a))
    kept = F.filter(new_paths, lambda p: p != path)
    urls = F.array_distinct(F.transform(kept, lambda p: F.concat(prefix, p, tail)))
    return F.when((suffix != "") & (u.isNotNull()), urls).otherwise(F.array().cast("array<string>"))


def alternate_feed_url(html, base) -> Column:
    """First ``<link rel=..alternate..>`` with an href and an RSS/Atom/XML type, joined onto ``base``."""
    h = F.col(html) if isinstance(html, str) else html
    b = F.col(base) if isinstance(base, str) else base
    tags = F.coalesce(F.regexp_extract_all(h, F.lit(ALTERNATE_LINK), 0), F.array().cast("array<string>"))
    cands = F.transform(tags, lambda t: F.struct(F.lower(F.regexp_extract(t, LINK_TYPE, 1)).alias("type"),
                                                 F.regexp_extract(t, LINK_HREF, 1).alias("href")))
    feeds = F.filter(cands, lambda c: (c["href"] != "") & (c["type"].contains("rss") | c["type"].contains("atom")
                                                             | c["type"].endswith("xml")))
    href = F.get(feeds, 0)["href"]
    return F.when(href.isNotNull(), resolve_url(b, href))


def healthy_feeds(feeds: DataFrame, feed_status: DataFrame, enabled: bool = True) -> DataFrame:
    """Feeds whose probe answered exactly 200 (only when the health check is enabled)."""
    if not enabled:
        return feeds
    ok = feed_status.where(F.col("status") == 200).select(F.col("feed_url").alias("_ok_url")).distinct()
    return feeds.join(ok, feeds["feed_url"] == ok["_ok_url"], "left_semi")


def alternate_feed_requests(payloads: DataFrame, text_col: str = "text", tried_col: str | None = None) -> DataFrame:
    """Feeds to fetch again: for each payload that failed to parse (even after repair), the
    alternate RSS/Atom link found in its HTML, unless that URL was already tried (the feed URL
    and the candidates that failed before the successful fetch: ``resolve_fetch``'s
    ``tried_urls``; by default only the feed URL). Returns ``(source, feed_url, alt_url)``;
    fetching is done outside."""
    t = F.col(text_col)
    first = F.from_xml(t, FEED_SCHEMA, XML_OPTIONS)
    second = F.from_xml(repair_xml(t), FEED_SCHEMA, XML_OPTIONS)
    failed = bind(first, lambda f: f.isNull() | f["_corrupt_record"].isNotNull()) & \
        bind(second, lambda s: s.isNull() | s["_corrupt_record"].isNotNull())
    alt = alternate_feed_url(t, F.col("feed_url"))
    tried = F.col(tried_col) if tried_col else F.array(F.col("feed_url"))
    out = payloads.where(failed).select("source", "feed_url", alt.alias("alt_url"), tried.alias("_tried"))
    return out.where(F.col("alt_url").isNotNull() & ~F.coalesce(F.array_contains("_tried", F.col("alt_url")),
                                                                  F.lit(False))).drop("_tried")
