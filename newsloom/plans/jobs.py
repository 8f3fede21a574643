"""End-to-end run for one mode: collect -> classify -> dedupe -> generate -> link health."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.brief import adaptive_brief_pruned, adaptive_briefs, render_briefs
from ..operators.dedupe import duplicate_ids, flag_duplicates, index_titles
from ..operators.index import KeyIndex
from ..operators.ingest import collected_items, new_articles, rewrite_changes, with_changes
from ..operators.links import link_health_summary
from ..operators.score import append_scored, content_of, score_articles
from ..operators.summary import DailyTops
from ..operators.util import lookup_join, stored
from ..sources.catalog import DEFAULT_MIN_SCORE, allowed_source_names, select_sources
from ..sources.templates import template_table


@dataclass
class RunResult:
    raw: DataFrame          # articles after the run (stored rows with rewritten URLs, plus new rows)
    scored: DataFrame       # scored table after the run
    brief: DataFrame
    health: DataFrame
    new_rows: DataFrame     # articles inserted by this run (stored)
    rewritten: DataFrame    # (id, url) of stored articles whose URL this run repaired (stored)
    new_scores: DataFrame   # scores added by this run, with their duplicate flags (stored)


def run_mode(raw: DataFrame, scored: DataFrame | None, responses: DataFrame | None, catalog: DataFrame,
             payloads: DataFrame | None, link_status: DataFrame, mode: str, as_of: str,
             feed_status: DataFrame | None = None, template: str | None = None, answers: DataFrame | None = None,
             titles: KeyIndex | None = None, templates: DataFrame | None = None,
             daily: DailyTops | None = None) -> RunResult:
    """One run of the pipeline for ``mode`` at ``as_of``.

    ``payloads`` are the fetched feeds of the mode's sources; with a crawler's ``answers`` by URL the feeds come from
    the catalog's selection (or, if given, from ``payloads``) and go through the fetch rounds. ``responses`` are the
    model answers (articles without one get the offline answer). Scores are
    incremental: only articles missing from ``scored`` are scored, with the
    mode's source filter (none when the mode selects no catalog entry). ``templates`` (template_name, template) replace
    the built-in texts by name.

    The run's changes (items, rewrites, new rows, new scores, new duplicate flags) are stored once, as narrow as they
    are; later steps lay them over the tables: the table of articles is joined with the rewrites only where it is
    written, the brief applies them to its few rows. A ``titles`` index makes the duplicate check read the titles of
    newly scored articles only; without one all titles are compared, and old scores are checked too. With ``daily``
    summaries, which the run brings up to date, the brief is answered from them.
    """
    m = (mode or "weekly").strip().lower()
    allowed = allowed_source_names(select_sources(catalog, m))
    if payloads is None:
        from ..sources.fetch import selected_feeds
        payloads = selected_feeds(catalog, m)
    items = collected_items(payloads, feed_status, answers)
    changes = stored(rewrite_changes(raw, items), "rewrites")
    new_rows = new_articles(raw, items, changes, as_of)
    if "ingested_date" in raw.columns:
        new_rows = new_rows.withColumn("ingested_date", F.to_date("ingested_at"))
    new_rows = stored(new_rows, "new-articles")
    # Rewrites change URLs only, which scoring and the duplicate check don't read.
    articles = raw.unionByName(new_rows.select(*raw.columns))
    new_scores = stored(score_articles(articles, scored, responses, catalog, m, allowed), "new-scores")
    if titles is not None:
        if not titles.buckets():
            index_titles(titles, raw.select("id", "title"), -1)
        index_titles(titles, new_rows.select("id", "title"), raw.agg(F.max("id")).first()[0] or 0)
        ids = new_scores.select(F.col("raw_id").alias("id"))
        if "ingested_date" in raw.columns:
            ids = ids.join(articles.select("id", "ingested_date"), "id")
        ids = stored(ids, "new-ids")
        own, exact = content_of(articles, ids, ["id", "title"])
        own = own if exact else own.join(ids.select("id"), "id", "left_semi")
        new_scores = stored(flag_duplicates(new_scores, own, titles=titles), "flagged")
        scored_all = append_scored(scored, new_scores)
        flips = None
    else:
        unflagged = append_scored(scored, new_scores)
        flips = stored(unflagged.where(~F.coalesce("is_duplicate", F.lit(False))).select("raw_id").join(
            duplicate_ids(articles).select(F.col("id").alias("raw_id")), "raw_id", "left_semi"), "flags")
        scored_all = _with_flags(unflagged, flips)
        new_scores = _with_flags(new_scores, flips)
    threshold = F.coalesce(catalog.select(F.max_by("min_score_threshold",
                                                    F.struct("doc_ord", "domain_pos", "source_pos"))).scalar(),
                           F.lit(DEFAULT_MIN_SCORE))
    if daily is not None:
        changed = new_scores.select(F.col("raw_id").alias("id")).unionByName(changes.select("id"))
        if flips is not None:
            changed = changed.unionByName(flips.select(F.col("raw_id").alias("id")))
        if daily.empty():
            changed = articles.select("id")  # the first run makes all days
        present = with_changes(raw, changes).unionByName(new_rows.select(*raw.columns))
        daily.update(present, scored_all, changed)
        top = adaptive_briefs(daily.rows([as_of], articles, scored_all, threshold, allowed), as_of)
    else:
        top = adaptive_brief_pruned(articles, scored_all, as_of, threshold, allowed)
    top = with_changes(top, changes)
    text = template if template is not None else template_table(raw.sparkSession, templates, "article", [m])
    brief = render_briefs(top, {"mode": m}, as_of, text)
    health = link_health_summary(brief, link_status, key="mode")
    raw_all = with_changes(raw, changes).unionByName(new_rows.select(*raw.columns))
    return RunResult(raw_all, scored_all, brief, health, new_rows,
                     changes.select("id", F.col("new_url").alias("url")), new_scores)


def _with_flags(scores: DataFrame, flips: DataFrame) -> DataFrame:
    """``scores`` with ``is_duplicate`` set for the ids of ``flips``."""
    joined = lookup_join(scores, flips.withColumn("_flip", F.lit(True)), "raw_id", "left")
    flag = F.coalesce("is_duplicate", F.lit(False)) | F.col("_flip").isNotNull()
    return joined.select(*[flag.alias(c) if c == "is_duplicate" else F.col(c) for c in scores.columns])
