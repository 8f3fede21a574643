"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the provided tables through ``newsloom.sources.bindings`` and
runs over whole tables. Column names match the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import py_round
from ..functions.signals import SIGNALS, clamp01_text, keyword_ratio, parse_signals
from ..functions.text import canonical_url, extract_urls, markdown_urls, normalize_text, repair_link, resolve_link
from ..operators import brief as BR
from ..operators.dedupe import duplicate_ids, flag_duplicates
from ..operators.score import score_articles, unscored_articles, with_source_weights
from ..sources import bindings as B
from ..sources.catalog import (parse_catalog, parse_legacy_catalog, select_sources, source_lookup,
                               allowed_source_names)

AS_OF = B.AS_OF
BRIEF_AS_OF = ("2024-01-31", "2024-02-04", "2024-02-20", "2024-04-15", "2025-01-25", "2027-01-01")


# ---- shared pipeline pieces --------------------------------------------------------------

_CATALOGS: dict = {}


def release():
    """Drops the cached catalogs, so that the next query pays for its own."""
    for df in _CATALOGS.values():
        df.unpersist()
    _CATALOGS.clear()


def catalog(spark, d):
    """The flattened catalog, built once per session and table folder.

    A catalog is configuration-sized; caching it keeps its size check and the
    default-weight lookup from re-reading ``documents`` (a cached block that is
    lost is recomputed from lineage)."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _CATALOGS:
        _CATALOGS[key] = parse_catalog(B.catalog_documents(spark, d)).cache()
    return _CATALOGS[key]


def scored_weekly(spark, d, mode="weekly"):
    raw = B.articles_raw(spark, d)
    return score_articles(raw, None, B.model_responses(spark, d), catalog(spark, d), mode)


def scored_flagged(spark, d):
    return flag_duplicates(scored_weekly(spark, d), B.articles_raw(spark, d))


def eligible(spark, d):
    return BR.eligible_articles(B.articles_raw(spark, d), scored_flagged(spark, d))


# ---- A: sources ---------------------------------------------------------------------------

def q_source_catalog(spark, d):
    c = catalog(spark, d)
    return c.select("doc_ord", "domain_pos", "source_pos", "domain", "domain_weight",
                    F.array_join("tags", ",").alias("tags"), "description", "name", "url", "weight", "priority",
                    "default_weight", "min_score_threshold")


def q_source_catalog_legacy(spark, d):
    c = parse_legacy_catalog(B.legacy_catalog_documents(spark, d))
    return c.select("doc_ord", "domain_pos", "source_pos", "domain", "name", "url")


def q_select_sources(spark, d):
    c = catalog(spark, d)
    out = None
    for mode in (" Weekly ", "AI_RADAR"):
        s = select_sources(c, mode).select("mode", "domain", "name", "url", "selected", "ingestable", "filter_active")
        out = s if out is None else out.unionByName(s)
    return out


# ---- B/C: filters and joins ---------------------------------------------------------------

def q_unscored_articles(spark, d):
    raw = B.articles_raw(spark, d).select("id", "source")
    allowed = allowed_source_names(select_sources(catalog(spark, d), "weekly"))
    return unscored_articles(raw, B.scored_existing(spark, d), allowed).select("id", "source")


def q_source_lookup(spark, d):
    lk = source_lookup(catalog(spark, d))
    return lk.select("lookup_key", "domain", "domain_weight", F.array_join("tags", ",").alias("tags"), "source_weight")


def q_scored_articles_join(spark, d):
    j = BR.scored_articles_join(B.articles_raw(spark, d), scored_flagged(spark, d))
    return j.select("id", "title", "url", "impact_score", "is_duplicate", "db_engine", "topic")


def q_eligible_articles(spark, d):
    return eligible(spark, d).select("id", "source", "title", "impact_score")


def q_duplicate_ids(spark, d):
    return duplicate_ids(B.articles_raw(spark, d))


def q_flag_duplicates(spark, d):
    return scored_flagged(spark, d).select("raw_id", "impact_score", "is_duplicate")


# ---- K2 scoring ---------------------------------------------------------------------------

def q_score_weekly(spark, d):
    return scored_weekly(spark, d, "weekly")


def q_score_ai_radar(spark, d):
    return scored_weekly(spark, d, "ai_radar")


def q_score_articles(spark, d):
    """Incremental run: only articles not scored before (labels = already scored), weekly."""
    raw = B.articles_raw(spark, d)
    return score_articles(raw, B.scored_existing(spark, d), B.model_responses(spark, d), catalog(spark, d), "weekly")


def q_classify_prompt(spark, d):
    """Classification prompts of both modes for every article: templates stored as files, read back and joined by mode."""
    from ..functions.markdown import classify_prompt
    from ..operators.util import shared_folder
    from ..sources.templates import CLASSIFY_TEMPLATES, read_templates, template_table, write_templates
    path = shared_folder(spark, "templates")
    write_templates(spark, {f"classify_{m}": t for m, t in CLASSIFY_TEMPLATES.items()}, path)
    texts = template_table(spark, read_templates(spark, path), "classify", CLASSIFY_TEMPLATES)
    rows = B.articles_raw(spark, d).select("id", "content", F.explode(F.array(*[F.lit(m) for m in CLASSIFY_TEMPLATES])).alias("mode"))
    return rows.join(texts, "mode").select("id", "mode", classify_prompt(F.col("template"), F.col("content")).alias("prompt"))


def q_offline_signals(spark, d):
    """Scoring with no model answers at all: every article gets the offline constants."""
    raw = B.articles_raw(spark, d)
    return score_articles(raw, None, None, catalog(spark, d), "weekly")


def q_keyword_score(spark, d):
    raw = B.articles_raw(spark, d).select("id", "source", "content")
    w = with_source_weights(raw, catalog(spark, d))
    return w.select("id", py_round(keyword_ratio(F.col("content"), F.col("tags")), 3).alias("keyword_score"))


def q_parse_signals(spark, d):
    r = B.model_responses(spark, d).select("raw_id", parse_signals(F.col("response")).alias("s"))
    return r.select("raw_id", F.col("s.ok").alias("ok"), *[F.col(f"s.{k}").alias(k) for k in SIGNALS],
                    F.col("s.db_engine").alias("db_engine"), F.col("s.topic").alias("topic"))


def q_clamp_signals(spark, d):
    """clamp01 over raw signal text (numbers, quoted numbers, nulls) pulled from the answers."""
    r = B.model_responses(spark, d)
    out = []
    for k in ("relevance", "architectural_impact", "production_impact"):
        out.append(clamp01_text(F.get_json_object("response", f"$.{k}")).alias(k))
    return r.select("raw_id", *out)


def q_normalize_text(spark, d):
    doc = B.table(spark, d, "documents")
    return doc.select("doc_id", normalize_text(F.col("text")).alias("normalized"))


# ---- F: top-k and briefs ------------------------------------------------------------------

def _brief_cols(df):
    return df.select("rank", "id", "title", "url", "impact_score", "window_days")


def q_adaptive_brief(spark, d):
    return _brief_cols(BR.adaptive_briefs(eligible(spark, d), "2024-01-31"))


def q_adaptive_brief_fallback(spark, d):
    return _brief_cols(BR.adaptive_briefs(eligible(spark, d), "2027-01-01"))


def q_briefs_by_domain(spark, d):
    """One adaptive top-7 per (domain, as_of) in one job; as_of values reach every window branch."""
    el = eligible(spark, d)
    raw = B.articles_raw(spark, d).select(F.col("id").alias("_id"), "source")
    dom = with_source_weights(raw, catalog(spark, d)).select("_id", "domain")
    el = el.join(dom, el["id"] == dom["_id"]).drop("_id")
    el = el.withColumn("as_of", F.explode(F.array(*[F.lit(a).cast("timestamp") for a in BRIEF_AS_OF])))
    out = BR.adaptive_briefs(el, F.col("as_of"), group_cols=["domain", "as_of"])
    return out.select("domain", F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "rank", "id", "impact_score",
                      "window_days")


def _daily(spark, d):
    """Daily summaries of the scored articles: built for those that carry labels, then updated by the others."""
    from ..operators.summary import DailyTops
    from ..operators.util import shared_folder, stored
    raw, flagged = B.articles_raw(spark, d), stored(scored_flagged(spark, d), "flagged")
    earlier = B.scored_existing(spark, d).select("raw_id")
    daily = DailyTops(spark, shared_folder(spark, "daily"))
    daily.update(raw, flagged.join(earlier, "raw_id", "left_semi"), earlier.select(F.col("raw_id").alias("id")))
    daily.update(raw, flagged, flagged.join(earlier, "raw_id", "left_anti").select(F.col("raw_id").alias("id")))
    return daily, raw, flagged


def q_daily_brief(spark, d):
    """The adaptive brief, answered from the daily summaries."""
    daily, raw, flagged = _daily(spark, d)
    return _brief_cols(BR.adaptive_briefs(daily.rows(["2024-01-31"], raw, flagged), "2024-01-31"))


def q_daily_briefs_by_domain(spark, d):
    """One brief per domain and as_of (all of every window branch), answered from one table of daily summaries."""
    daily, raw, flagged = _daily(spark, d)
    rows = daily.rows(BRIEF_AS_OF, raw, flagged)
    rows = with_source_weights(rows, catalog(spark, d)).select(*rows.columns, "domain")
    rows = rows.withColumn("as_of", F.explode(F.array(*[F.lit(a).cast("timestamp") for a in BRIEF_AS_OF])))
    out = BR.adaptive_briefs(rows, F.col("as_of"), group_cols=["domain", "as_of"])
    return out.select("domain", F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "rank", "id", "impact_score", "window_days")


def q_top_articles(spark, d):
    return BR.top_articles(eligible(spark, d)).select("id", "title", "url", "impact_score")


def q_top_scored_report(spark, d):
    return BR.top_scored_report(B.articles_raw(spark, d), scored_flagged(spark, d), min_score=0.6, k=10)


# ---- H: scalar functions on provided text ---------------------------------------------------

def _stackexchange_urls(spark, d):
    p = B.table(spark, d, "pages")
    return p.select("page_id", F.concat(F.lit("https://dba.stackexchange.com/questions/"), F.col("page_id").cast("string"),
                                        F.lit("/some-slug?ref="), (F.col("page_id") % 3).cast("string")).alias("se_url"),
                    "url", "html")


def q_canonical_url(spark, d):
    p = _stackexchange_urls(spark, d)
    return p.select("page_id", canonical_url(F.col("se_url")).alias("se_canonical"),
                    canonical_url(F.col("url")).alias("url_canonical"))


def _link_items(spark, d):
    """pages -> items whose link was cut at '?' or '#' and whose content links the full URL."""
    p = _stackexchange_urls(spark, d)
    cut = F.regexp_extract(F.col("url"), r"^[^?#]*", 0)
    content = F.concat(F.lit('<a href="'), F.col("url"), F.lit('">x</a> see '), F.col("se_url"), F.lit(" and "),
                       F.col("url"))
    return p.select("page_id", "url", "se_url", cut.alias("link"), content.alias("content"))


def q_extract_urls(spark, d):
    it = _link_items(spark, d)
    return it.select("page_id", F.posexplode(extract_urls(F.col("content"))).alias("pos", "found_url"))


def q_repair_link(spark, d):
    it = _link_items(spark, d)
    return it.select("page_id", "link", repair_link(F.col("link"), F.col("content")).alias("repaired"))


def q_resolve_links(spark, d):
    p = B.table(spark, d, "pages")
    hrefs = p.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(r'(?i)href="([^"]+)"'), 1))
                     .alias("pos", "href"))
    return hrefs.select("page_id", "pos", "href", resolve_link(F.col("href"), F.col("url")).alias("resolved"))


def registry() -> dict:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}


# ---- K4 brief text, H13-H16/H21, K5 link health -----------------------------------------------

def q_brief_markdown(spark, d):
    from ..sources.templates import article_template
    top = BR.adaptive_briefs(eligible(spark, d), "2024-01-31")
    out = BR.render_briefs(top, {"mode": "weekly"}, "2024-01-31", article_template("weekly"))
    return out.select("mode", "article_count", "markdown")


def _mode_briefs(spark, d):
    """Briefs of both modes in one job: articles are scored for both at once, titles compared once."""
    from ..sources.templates import template_table
    modes = ("weekly", "ai_radar")
    raw = B.articles_raw(spark, d)
    scored = flag_duplicates(score_articles(raw, None, B.model_responses(spark, d), catalog(spark, d), modes), raw)
    top = BR.adaptive_briefs(BR.eligible_articles(raw, scored), "2024-01-31", group_cols=["mode"])
    groups = spark.createDataFrame([(m,) for m in modes], "mode string")
    return BR.render_briefs(top, groups, "2024-01-31", template_table(spark, None, "article", modes), group_cols=["mode"])


def q_render_prompt(spark, d):
    """Weekly and ai_radar prompts for the adaptive top-7 of each mode's scores."""
    return _mode_briefs(spark, d).select("mode", "prompt")


def _page_briefs(spark, d, block=10):
    """Markdown briefs over blocks of 10 pages: '- title (link)' lines, link cut at '?' or '#'."""
    p = B.table(spark, d, "pages")
    title = F.regexp_replace(F.regexp_extract("html", r"<title>(.*?)</title>", 1), "&amp;", "&")
    cut = F.regexp_extract(F.col("url"), r"^[^?#]*", 0)
    rows = p.select((F.col("page_id") / block).cast("long").alias("brief_id"), "page_id", "url", title.alias("title"),
                    cut.alias("cut"))
    return rows.groupBy("brief_id").agg(F.array_sort(F.collect_list(F.struct("page_id", "url", "title", "cut"))).alias("p"))


def q_repair_markdown_urls(spark, d):
    from ..functions.markdown import normalize_url_prefixes
    b = _page_briefs(spark, d)
    md = F.concat(F.lit("# Brief\n"), F.array_join(F.transform("p", lambda x: F.concat(
        F.lit("- "), x["title"], F.lit(" ("), x["cut"], F.lit(")\n- again ("), x["cut"], F.lit(")"))), "\n"))
    urls = F.transform("p", lambda x: x["url"])
    return b.select("brief_id", normalize_url_prefixes(md, urls).alias("markdown"))


def q_sources_section(spark, d):
    from ..functions.markdown import replace_sources_section
    b = _page_briefs(spark, d)
    head = F.concat(F.lit("# Brief "), F.col("brief_id").cast("string"), F.lit("\n"),
                    F.array_join(F.transform("p", lambda x: F.concat(F.lit("- "), x["title"])), "\n"), F.lit("\n"))
    md = F.when(F.col("brief_id") % 2 == 0,
                F.concat(head, F.lit("## Sources draft\n- old\n### keep\n## Next\nend  ")))\
        .otherwise(F.concat(head, F.lit("  \n\t")))
    urls = F.transform("p", lambda x: x["url"])
    return b.select("brief_id", replace_sources_section(md, urls).alias("markdown"))


def _link_briefs(spark, d):
    b = _page_briefs(spark, d)
    md = F.concat(F.lit("## Brief\n"), F.array_join(F.transform("p", lambda x: F.concat(
        F.lit("- "), x["title"], F.lit(" ("), x["url"], F.lit(")"))), "\n"), F.lit("\n"))
    return b.select("brief_id", md.alias("markdown"))


def q_markdown_urls(spark, d):
    return _link_briefs(spark, d).select("brief_id", F.posexplode(markdown_urls(F.col("markdown"))).alias("pos", "url"))


def q_link_health(spark, d):
    from ..operators.links import link_health
    return link_health(_link_briefs(spark, d), B.link_status(spark, d)).select("brief_id", "pos", "url", "status", "ok")


def q_link_health_summary(spark, d):
    from ..operators.links import link_health_summary
    return link_health_summary(_link_briefs(spark, d), B.link_status(spark, d))


def q_reject_json_output(spark, d):
    """JSON guard over model answers and brief-like texts: TRUE when the text is valid JSON."""
    from ..functions.markdown import is_json_text
    r = B.model_responses(spark, d)
    return r.select("raw_id", is_json_text(F.col("response")).alias("is_json"))


def q_offline_brief(spark, d):
    """Offline brief of each 10-page block's prompt (first 7 distinct URLs)."""
    from ..functions.markdown import offline_brief
    b = _link_briefs(spark, d)
    return b.select("brief_id", offline_brief(F.col("markdown")).alias("markdown"))


# ---- A/K1: feeds and ingest ------------------------------------------------------------------

def q_decode_payload(spark, d):
    from ..sources.feeds import decode_payload
    pp = B.page_payloads(spark, d)
    return pp.select("page_id", decode_payload(F.col("body")).alias("text"))


def _items(spark, d):
    from ..operators.ingest import feed_items
    return feed_items(B.feed_payloads(spark, d))


def q_parse_feed(spark, d):
    return _items(spark, d).select("source", "source_ord", "item_ord", "title", "link", "published", "content")


def q_repair_xml(spark, d):
    from ..sources.feeds import parse_feed
    parsed = parse_feed(B.feed_payloads(spark, d), text_col="body")
    return parsed.groupBy("source", "parse_status").agg(F.count("item_ord").alias("items"))


def _valid(spark, d):
    from ..operators.ingest import valid_items
    return valid_items(_items(spark, d))


def q_valid_items(spark, d):
    return _valid(spark, d).select("source", "item_ord", "title", "link", "original_link")


def q_resolve_fetch(spark, d):
    from ..sources.feeds import resolve_fetch
    r = resolve_fetch(B.fetch_attempts(spark, d))
    return r.select("source", "feed_url", "fetched_url", "attempt_no", F.length("body").alias("body_chars"),
                    "error_url", "error")


def q_fetch_rounds(spark, d):
    """Where each feed was found, in which round, and its number of items."""
    from ..sources.fetch import fetch_rounds
    got = fetch_rounds(B.feed_payloads(spark, d).drop("body"), B.feed_answers(spark, d))
    return got.items.where("item_ord is not null").groupBy("source", "source_ord", "round", "fetched_url").agg(
        F.count(F.lit(1)).alias("items"))


def q_fetch_requests(spark, d):
    """What to fetch next, when so far only the feeds' own URLs were asked for."""
    from ..sources.fetch import fetch_rounds
    answers = B.feed_answers(spark, d).where(F.col("url").endswith("/rss.xml"))
    got = fetch_rounds(B.feed_payloads(spark, d).drop("body"), answers)
    return got.pending.select("source", "round", "attempt_no", "url")


def q_candidate_feed_urls(spark, d):
    from ..sources.feeds import candidate_feed_urls
    c = B.candidate_sources(spark, d)
    return c.select("page_id", "feed_url", F.posexplode(candidate_feed_urls(F.col("feed_url"))).alias("pos", "candidate"))


def q_alternate_feed(spark, d):
    from ..sources.feeds import alternate_feed_url
    p = B.alternate_pages(spark, d)
    return p.select("page_id", alternate_feed_url(F.col("html"), F.col("url")).alias("alt_url"))


def q_healthy_feeds(spark, d):
    from ..sources.feeds import healthy_feeds
    return healthy_feeds(B.feed_payloads(spark, d).select("source", "feed_url"), B.feed_status(spark, d))


def _stored(spark, d):
    return B.articles_raw(spark, d).unionByName(B.stored_feed_articles(spark, d))


def q_rewrite_urls(spark, d):
    from ..operators.ingest import rewrite_urls
    r = rewrite_urls(_stored(spark, d), _valid(spark, d))
    return r.where(F.col("url") != F.col("url_before")).select("id", "url_before", "url")


def q_ingest_new(spark, d):
    from ..operators.ingest import ingest_new, rewrite_urls
    items = _valid(spark, d)
    raw = rewrite_urls(_stored(spark, d), items).drop("url_before")
    new = ingest_new(raw, items, AS_OF)
    return new.select("id", "source", "title", "url", "published_at", "content",
                      F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


def q_assign_ids(spark, d):
    """Ids for every valid feed item, numbered after the largest stored article id."""
    from ..operators.ingest import assign_ids
    items = _valid(spark, d).select("source_ord", "item_ord", "link")
    start = _stored(spark, d).select(F.max("id")).scalar()
    return assign_ids(items, ["source_ord", "item_ord"], start).select("id", "source_ord", "item_ord", "link")


def q_collect(spark, d):
    """The whole collect job: health check on, bodies from the fetch rounds (candidates, alternate links)."""
    from ..operators.ingest import collect
    _, new = collect(_stored(spark, d), B.feed_payloads(spark, d).drop("body"), AS_OF, feed_status=B.feed_status(spark, d),
                     answers=B.feed_answers(spark, d))
    return new.select("id", "source", "title", "url")


# ---- J1 user scorer, I1 streaming ---------------------------------------------------------------

def q_score_with_fn(spark, d):
    """Scores from a scorer's answers, kept in a table: the first half of the articles is answered by an earlier run. The
    scorer stands in for a model: it rates a text by its length and lines."""
    from ..operators.scorer import durable_responses, length_scorer
    from ..operators.util import shared_folder
    raw = B.articles_raw(spark, d)
    folder = shared_folder(spark, "answers")
    earlier = raw.join(B.scored_existing(spark, d).select(F.col("raw_id").alias("id")), "id", "left_semi")
    durable_responses(earlier, length_scorer, folder, pause_sec=0)
    return score_articles(raw, None, durable_responses(raw, length_scorer, folder, pause_sec=0), catalog(spark, d), "weekly")


def q_stream_ingest(spark, d):
    """Payload files -> Structured Streaming (availableNow) -> sink.

    Payloads are bytes (UTF-8, gzip, UTF-16) and only healthy feeds count. They are written twice (two copies of the
    files, at their own partitioning), so the second copy must add nothing. Returns the whole rows that the stream
    stored and the URLs that it changed in the articles stored before."""
    from ..operators.util import shared_folder
    from ..streaming.ingest_stream import read_rewrites, read_sink, start_ingest_stream
    root = shared_folder(spark, "stream")
    payloads = B.stream_payloads(spark, d)
    for copy in ("a", "b"):
        payloads.write.mode("overwrite").parquet(f"{root}/in/{copy}")
    q = start_ingest_stream(spark, f"{root}/in/*", f"{root}/sink", f"{root}/checkpoint",
                            seed=_stored(spark, d), as_of=AS_OF, files_per_batch=64, feed_status=B.feed_status(spark, d))
    q.awaitTermination()
    new = read_sink(spark, f"{root}/sink").select(
        F.lit("new").alias("kind"), F.lit(None).cast("bigint").alias("id"), "source", "title", "url", "published_at", "content",
        F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))
    changed = read_rewrites(spark, f"{root}/sink").select(F.lit("rewritten").alias("kind"), "id", "url")
    return new.unionByName(changed, allowMissingColumns=True)


# ---- K6 full run, A15 brief sink ------------------------------------------------------------------

def q_full_run(spark, d):
    """Weekly run: collect the feeds (health check on), score what is new with the weekly source
    filter, flag duplicates, pick the adaptive top-7, write the brief, check its links."""
    from .jobs import run_mode
    r = run_mode(_stored(spark, d), B.scored_existing(spark, d), B.model_responses(spark, d), catalog(spark, d),
                 B.feed_payloads(spark, d).drop("body"), B.link_status(spark, d), " Weekly", "2024-01-31",
                 feed_status=B.feed_status(spark, d), answers=B.feed_answers(spark, d))
    return r.brief.join(r.health, "mode").select("mode", "article_count", "url_count", "ok_count", "healthy",
                                                 "markdown")


def q_brief_sink(spark, d):
    """Write the weekly and ai_radar briefs (one file per mode, replacing earlier ones) and read them back."""
    from ..operators.util import shared_folder
    path = shared_folder(spark, "briefs")
    briefs = _mode_briefs(spark, d)
    BR.write_briefs(briefs, path)  # one job: both modes share scans and exchanges
    return BR.read_briefs(spark, path).select("mode", F.col("content").alias("markdown"))
