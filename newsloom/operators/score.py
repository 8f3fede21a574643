"""Scoring job: pick unscored articles, read model signals, look up source weights, score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import memo_column
from ..functions.signals import impact_score, offline_signals, parse_signals, with_impact_score, with_keyword_score
from ..sources.catalog import DEFAULT_WEIGHT, article_lookup_key, source_lookup
from .util import is_empty, lookup_join, stored

# At most this many ids are broadcast (8 bytes each) to filter the scan of article texts.
BROADCAST_IDS = 4_000_000
# At most this many dates are written into the partition filter of that scan.
FILTER_DATES = 1_000

SCORED_COLUMNS = ["raw_id", "db_engine", "topic", "impact_score", "is_duplicate"]


def filter_sources(articles: DataFrame, allowed: DataFrame | None, source_col: str = "source") -> DataFrame:
    """``source IN (allowed)``, exact and case-sensitive; an empty ``allowed`` means no filter.

    ``allowed`` has one column ``source``. It is joined as a measured dimension and the emptiness test is a scalar subquery.
    """
    if allowed is None:
        return articles
    names = (allowed.where(F.col("source").isNotNull()).select(F.col("source").alias("_src")).distinct()
             .withColumn("_allowed", F.lit(True)))
    keyed = articles.withColumn("_src", F.col(source_col))
    joined = lookup_join(keyed, names, "_src", "left")
    return joined.where(F.col("_allowed").isNotNull() | is_empty(names)).drop("_allowed", "_src")


def unscored_articles(raw: DataFrame, scored: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Raw articles whose id is ``NOT IN (SELECT raw_id FROM scored)``.

    Written as a shuffle-able left anti join. SQL's three-valued ``NOT IN``
    makes the result empty as soon as one ``raw_id`` is NULL; that case is a
    scalar subquery evaluated once, not a null-aware broadcast join.
    """
    ids = scored.select(F.col("raw_id").alias("_sid"))
    no_nulls = is_empty(ids.where(F.col("_sid").isNull()))
    picked = raw.join(ids, raw["id"] == ids["_sid"], "left_anti").where(no_nulls)
    return filter_sources(picked, allowed)


def with_signals(articles: DataFrame, responses: DataFrame | None) -> DataFrame:
    """Attach parsed model signals; articles without a response get the offline constants.

    Articles whose response is not one JSON object are dropped (they stay unscored
    and are picked again by the next run).
    """
    if responses is None:
        return articles.withColumn("sig", offline_signals())
    resp = responses.select(F.col("raw_id").alias("_rid"), F.col("response").alias("_response"))
    joined = articles.join(resp, articles["id"] == resp["_rid"], "left")
    # Generated from an array that is empty for an unusable answer: the filter isn't copied below, so each answer is parsed once.
    sig = memo_column("with_signals", lambda: F.filter(
        F.array(F.when(F.col("_rid").isNull(), offline_signals()).otherwise(parse_signals(F.col("_response")))),
        lambda s: s["ok"]))
    return joined.select(*[F.col(c) for c in articles.columns], F.explode(sig).alias("sig"))


def with_source_weights(articles: DataFrame, catalog: DataFrame) -> DataFrame:
    """Join the catalog lookup on ``lower(normalize(source))``; a miss gets the default weight and no tags."""
    lookup = source_lookup(catalog).withColumnRenamed("lookup_key", "_key")
    dflt = catalog.select(F.max_by("default_weight", F.struct("doc_ord", "domain_pos", "source_pos"))).scalar()
    dflt = F.coalesce(dflt, F.lit(DEFAULT_WEIGHT))
    keyed = articles.withColumn("_key", article_lookup_key("source"))
    j = lookup_join(keyed, lookup, "_key", "left")
    return j.select(
        *[F.col(c) for c in articles.columns],
        F.coalesce(F.col("domain"), F.lit("general")).alias("domain"),
        F.coalesce(F.col("domain_weight"), dflt).alias("domain_weight"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
        F.coalesce(F.col("source_weight"), dflt).alias("source_weight"))


def content_of(raw: DataFrame, ids: DataFrame, columns: list[str]) -> tuple[DataFrame, bool]:
    """``(rows, exact)``: ``columns`` of the ``raw`` rows whose id is in ``ids`` (id and, if ``raw`` has it,
    ingested_date; stored and narrow), read so that the texts of other rows stay on disk where the layout allows.

    The ids' range is pushed into the scan as literals: new articles have the largest ids, so row groups of scored
    ones are skipped. Where ``raw`` is partitioned by ingest date, only the dates of ``ids`` are listed. Up to
    BROADCAST_IDS ids then filter the rows map-side, before anything is computed on a text, and ``exact`` is true.
    With more ids the rows come unfiltered (within range and dates): the caller joins its narrow result to ``ids``,
    as the texts are not to be shuffled."""
    n, low, high = ids.agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
    if low is None:
        return raw.select(*columns).where("false"), True
    rows = raw.where(F.col("id").between(low, high))
    if "ingested_date" in raw.columns:
        dates = [r[0] for r in ids.select("ingested_date").distinct().limit(FILTER_DATES + 1).collect()]
        if len(dates) <= FILTER_DATES:
            known = F.col("ingested_date").isin([d for d in dates if d is not None])
            rows = rows.where(known | F.col("ingested_date").isNull() if None in dates else known)
    rows = rows.select(*columns)
    if n > BROADCAST_IDS:
        return rows, False
    return rows.join(F.broadcast(ids.select(F.col("id").alias("_id"))), F.col("id") == F.col("_id"), "left_semi"), True


def score_articles(raw: DataFrame, scored: DataFrame | None, responses: DataFrame | None, catalog: DataFrame,
                   mode: str | tuple[str, ...] = "weekly", allowed: DataFrame | None = None) -> DataFrame:
    """New ``articles_scored`` rows for every unscored article (``is_duplicate`` starts FALSE). Several modes give a row
    each, with a column ``mode``: texts, lookups and answers are the same for all and are read once.

    With a ``scored`` table the unscored ids are found first, on (id, source), and stored; ``content`` (the widest
    column) is then read for those (:func:`content_of`). The keyword ratio is computed on the scan, so only narrow
    rows are shuffled: ``content`` never is.
    """
    columns = ["id", "source", "content"]
    todo = None
    if scored is None:
        base = filter_sources(raw.select(*columns), allowed)
    else:
        narrow = raw.select("id", "source", *[c for c in ("ingested_date",) if c in raw.columns])
        todo = stored(unscored_articles(narrow, scored, allowed).drop("source"), "unscored")
        base, exact = content_of(raw, todo, columns)
    rows = with_keyword_score(with_source_weights(base, catalog)).drop("content", "tags")
    if todo is not None and not exact:
        rows = rows.join(todo.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_semi")
    signals = with_signals(rows, responses)
    if isinstance(mode, str):
        scored_new, label = with_impact_score(signals, mode), []
    else:
        scores = F.array(*[F.struct(F.lit(m).alias("mode"), impact_score(m).alias("impact_score")) for m in mode])
        scored_new, label = signals.withColumn("_s", F.explode(scores)).select("*", "_s.*"), ["mode"]
    return scored_new.select(
        *label, F.col("id").alias("raw_id"), F.col("sig.db_engine").alias("db_engine"), F.col("sig.topic").alias("topic"),
        "impact_score", F.lit(False).alias("is_duplicate"))


def append_scored(scored: DataFrame | None, new_rows: DataFrame) -> DataFrame:
    return new_rows if scored is None else scored.select(*SCORED_COLUMNS).unionByName(new_rows.select(*SCORED_COLUMNS))
