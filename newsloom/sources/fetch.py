"""Fetch rounds over tables: which URLs to request, which answers count, and which feeds need another round.

Fetching itself happens outside. A crawler writes one row per requested URL (``url, ok, body, error`` and, if known,
``content_encoding``); each round joins the requests of all feeds with these answers. A feed whose requests are not all
answered is pending: its next request is handed out and the run goes on without it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import stored
from .catalog import select_sources
from .feeds import candidate_feed_urls, decode_payload, parse_feed, resolve_fetch

FEED = ("source", "feed_url", "source_ord")
ROUNDS = 2  # the feed's own URLs, then the alternate feed that an HTML answer links to


@dataclass
class Fetched:
    items: DataFrame     # parsed rows of every answered feed (parse_feed's columns, source, feed_url, source_ord, round)
    pending: DataFrame   # requests to make next: source, feed_url, source_ord, round, attempt_no, url
    failed: DataFrame    # feeds without a usable answer: source, feed_url, source_ord, round, url, error


def selected_feeds(catalog: DataFrame, mode: str) -> DataFrame:
    """``(source, feed_url, source_ord)`` of the mode's catalog entries that have a name and a URL, in document order."""
    picked = select_sources(catalog, mode).where(F.col("selected") & F.col("ingestable"))
    # A catalog is configuration-sized: its entries are numbered from one sorted array.
    listed = picked.agg(F.array_sort(F.collect_list(F.struct("doc_ord", "domain_pos", "source_pos", "name", "url"))).alias("l"))
    return listed.select(F.posexplode("l").alias("source_ord", "e")).select(
        F.col("e.name").alias("source"), F.col("e.url").alias("feed_url"), "source_ord")


def first_requests(feeds: DataFrame) -> DataFrame:
    """Requests of the first round: each feed's own URL, then the other common feed paths beside it."""
    urls = F.concat(F.array("feed_url"), candidate_feed_urls("feed_url"))
    return feeds.select(*FEED, F.posexplode(urls).alias("attempt_no", "url"))


def _answered(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests with the answer to their URL. Of several answers to one URL a successful one counts, the largest body
    first (a retry that got through; any order gives the same row)."""
    cols = [c for c in ("body", "content_encoding", "error") if c in answers.columns]
    ok = F.coalesce(F.col("ok"), F.lit(False))
    rank = F.struct(ok.alias("ok"), F.length("body").alias("n"), *[F.col(c) for c in cols])
    best = answers.where(F.col("url").isNotNull()).groupBy(F.col("url").alias("_url")).agg(F.max(rank).alias("_a"))
    joined = requests.join(best, F.col("url") == F.col("_url"), "left")
    encoding = F.col("_a.content_encoding") if "content_encoding" in cols else F.lit(None).cast("string")
    return joined.select(*requests.columns, F.col("_a").isNotNull().alias("answered"), F.col("_a.ok").alias("ok"),
                         F.col("_a.body").alias("body"), encoding.alias("content_encoding"),
                         (F.col("_a.error") if "error" in cols else F.lit(None).cast("string")).alias("error"))


def _text(df: DataFrame) -> DataFrame:
    """The answer's text: bytes are unpacked and decoded, text is taken as it is."""
    if dict(df.dtypes)["body"] != "binary":
        return df.withColumnRenamed("body", "text")
    return df.withColumn("text", decode_payload(F.col("body"), F.col("content_encoding"))).drop("body")


def fetch_rounds(feeds: DataFrame, answers: DataFrame, rounds: int = ROUNDS) -> Fetched:
    """Items of ``feeds`` (source, feed_url, source_ord) from the crawler's ``answers``.

    Round 0 asks for a feed's own URL and its candidates; the first that answered counts. A feed whose answer can't be
    parsed, even after repair, asks in the next round for the alternate feed that its HTML names, unless that URL was
    tried. A feed without a success and with unanswered requests hands out the first of them. Each round stores its
    parsed rows once; the number of rounds is fixed, and from the second on they hold the unparsable feeds only.
    """
    requests = first_requests(feeds)
    items = pending = failed = None
    for number in range(rounds):
        own = _answered(requests, answers).withColumn("round", F.lit(number))
        tries = stored(own, "answers")
        known = tries.where("answered")
        found = resolve_fetch(known.withColumn("body", F.struct("body", "content_encoding")), ("source", "source_ord", "feed_url"))
        found = found.select(*FEED, "fetched_url", "tried_urls", "body.*", "error_url", "error")
        got = found.where(F.col("fetched_url").isNotNull())
        # Feeds without a success: the next unanswered request if there is one, else the first error.
        open_ = tries.join(got.select(*FEED), list(FEED), "left_anti").where("not answered").groupBy(*FEED, "round").agg(
            F.min(F.struct("attempt_no", "url")).alias("next")).select(*FEED, "round", "next.*")
        lost = found.where(F.col("fetched_url").isNull()).join(open_.select(*FEED), list(FEED), "left_anti").select(
            *FEED, F.lit(number).alias("round"), F.col("error_url").alias("url"), "error")
        texts = _text(got.drop("error_url", "error")).drop("content_encoding")
        parsed = stored(parse_feed(texts, with_alternate=True).withColumn("round", F.lit(number)), "parsed")
        unread = parsed.where("parse_status = 'rejected'")
        again = F.col("alternate_url").isNotNull() & ~F.array_contains("tried_urls", F.col("alternate_url"))
        last = number + 1 == rounds
        dropped = unread if last else unread.where(~F.coalesce(again, F.lit(False)))
        lost = lost.unionByName(dropped.select(*FEED, "round", F.col("fetched_url").alias("url"), F.lit("not a feed").alias("error")))
        rows = parsed.where("parse_status <> 'rejected'").drop("alternate_url", "tried_urls")
        items = rows if items is None else items.unionByName(rows)
        pending = open_ if pending is None else pending.unionByName(open_)
        failed = lost if failed is None else failed.unionByName(lost)
        requests = unread.where(again).select(*FEED, F.lit(0).alias("attempt_no"), F.col("alternate_url").alias("url"))
    return Fetched(items, pending, failed)
