"""Brief selection: eligible articles, adaptive look-back window, top-k per brief."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .score import filter_sources
from .util import is_empty

# Fixed values that must equal the reference's behaviour.
WINDOWS_DAYS = (7, 14, 30, 90, 365)
MIN_ARTICLES = 3
TOP_K = 7
MIN_SCORE = 0.6


def scored_articles_join(raw: DataFrame, scored: DataFrame) -> DataFrame:
    """``raw ⋈ scored ON scored.raw_id = raw.id``; content is not carried."""
    r = raw.select("id", "source", "title", "url", "ingested_at")
    s = scored.select("raw_id", "impact_score", "is_duplicate", "db_engine", "topic")
    return r.join(s, r["id"] == s["raw_id"])


def eligible_articles(raw: DataFrame, scored: DataFrame, threshold=MIN_SCORE,
                      allowed: DataFrame | None = None) -> DataFrame:
    """Score ``>=`` threshold (FLOAT score widened to DOUBLE; a number or a DOUBLE column),
    not duplicate, optional source filter. Scores of several modes keep their column ``mode``."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    s = scored.where((F.col("impact_score") >= thr) & (F.col("is_duplicate") == F.lit(False)))
    r = filter_sources(raw.select("id", "source", "title", "url", "ingested_at"), allowed)
    s = s.select("raw_id", "impact_score", *[c for c in scored.columns if c == "mode"])
    return r.join(s, r["id"] == s["raw_id"]).drop("raw_id")


def _bucket(ingested_at: Column, as_of: Column) -> Column:
    """Index of the narrowest look-back window holding the row; len(WINDOWS_DAYS) = only all-time."""
    expr = F.lit(len(WINDOWS_DAYS))
    for i, days in reversed(list(enumerate(WINDOWS_DAYS))):
        expr = F.when(ingested_at >= as_of - F.make_dt_interval(days=F.lit(days)), F.lit(i)).otherwise(expr)
    return expr


def adaptive_briefs(eligible: DataFrame, as_of, group_cols=(), k: int = TOP_K,
                    min_rows: int = MIN_ARTICLES) -> DataFrame:
    """Top-k per brief from the first window (7, 14, 30, 90, 365 days) holding ``min_rows`` rows.

    When no window reaches ``min_rows`` the 365-day rows are kept (1 or 2); when
    even that is empty, all time (NULL ``ingested_at`` included). Windows have no
    upper bound. Ties on score go to the smaller id.

    One pass: per-(brief, bucket) top rows with a partial window-group limit (each
    task ships at most ``max(k, min_rows)`` rows per bucket). The window is chosen
    from the kept rows, at most six buckets of them per brief, so the input is
    evaluated once.
    """
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    g = list(group_cols)
    b = eligible.withColumn("_bucket", _bucket(F.col("ingested_at"), as_of_col))
    order = [F.col("impact_score").desc(), F.col("id").asc()]
    keep = max(k, min_rows)
    top = (b.withColumn("_rn", F.row_number().over(Window.partitionBy(*g, "_bucket").orderBy(*order)))
           .where(F.col("_rn") <= keep).drop("_rn"))
    # Only ">= min_rows" and "> 0" are asked of the counts, so counts of the kept rows decide as those of all rows do.
    n = len(WINDOWS_DAYS)
    brief = Window.partitionBy(*g)
    counts = [F.count_if(F.col("_bucket") <= i).over(brief) for i in range(n)]
    chosen = F.when(counts[n - 1] > 0, F.lit(n - 1)).otherwise(F.lit(n))
    for i in reversed(range(n)):
        chosen = F.when(counts[i] >= min_rows, F.lit(i)).otherwise(chosen)
    picked = top.withColumn("_chosen", chosen).where(F.col("_bucket") <= F.col("_chosen"))
    ranked = picked.withColumn("rank", F.row_number().over(brief.orderBy(*order)))
    days = F.element_at(F.array(*[F.lit(d) for d in WINDOWS_DAYS], F.lit(None).cast("int")), F.col("_chosen") + 1)
    return ranked.where(F.col("rank") <= k).withColumn("window_days", days.cast("int")).drop("_bucket", "_chosen")


def top_articles(eligible: DataFrame, k: int = TOP_K) -> DataFrame:
    """``ORDER BY impact_score DESC, id LIMIT k`` (planned as TakeOrderedAndProject)."""
    return eligible.orderBy(F.col("impact_score").desc(), F.col("id").asc()).limit(k)


def top_scored_report(raw: DataFrame, scored: DataFrame, min_score: float, k: int = 10) -> DataFrame:
    """The documented ad-hoc report: title, url, score for score >= min_score, best k."""
    j = scored_articles_join(raw, scored).where(F.col("impact_score") >= F.lit(float(min_score)))
    return (j.orderBy(F.col("impact_score").desc(), F.col("id").asc()).limit(k)
            .select("id", "title", "url", "impact_score"))


def render_briefs(top: DataFrame, groups, as_of, template: str | DataFrame, group_cols=(),
                  markdown: Column | None = None) -> DataFrame:
    """Brief text per group from its ranked articles (at most k rows per group).

    ``articles`` = ``- title (url)`` lines in rank order; the prompt is the
    template with ``{{articles}}``/``{{date}}`` filled in. Without a supplied
    ``markdown`` column the offline brief is written from the prompt. Text that
    parses as JSON is refused (NULL = keep the previous brief). Then URL tokens
    are repaired and the Sources section is rebuilt from the article URLs.

    ``template`` is one text, or a table with a ``template`` for each value of its other columns, which are label
    columns.

    With ``group_cols`` every row of the ``groups`` DataFrame gets a brief (left
    join); without, ``groups`` is a dict of label columns for the single brief,
    which the global aggregate returns even when no article qualified.
    """
    from ..functions.markdown import (article_line, normalize_url_prefixes, offline_brief, reject_json_output,
                                      render_prompt, replace_sources_section)
    g = list(group_cols)
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    items = (top.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct(
        "rank", article_line(F.col("title"), F.col("url")).alias("line"), F.col("url")))).alias("_items"))
        if g else top.agg(F.array_sort(F.collect_list(F.struct(
            "rank", article_line(F.col("title"), F.col("url")).alias("line"), F.col("url")))).alias("_items")))
    if g:
        joined = groups.join(items, g, "left")
        labels = [F.col(c) for c in groups.columns]
    else:
        joined = items.withColumns({k: F.lit(v) for k, v in dict(groups).items()})
        labels = [F.col(k) for k in dict(groups)]
    if isinstance(template, DataFrame):
        joined = joined.join(template, [c for c in template.columns if c != "template"], "left")
        text_of = F.col("template")
    else:
        text_of = F.lit(template)
    arts = F.coalesce(F.col("_items"), F.array().cast("array<struct<rank:int,line:string,url:string>>"))
    articles_md = F.array_join(F.transform(arts, lambda x: x["line"]), "\n")
    source_urls = F.filter(F.transform(arts, lambda x: x["url"]), lambda u: u.isNotNull() & (u != ""))
    prompt = render_prompt(text_of, articles_md, as_of_col)
    text = markdown if markdown is not None else offline_brief(prompt)
    md = replace_sources_section(normalize_url_prefixes(reject_json_output(text), source_urls), source_urls)
    return joined.select(*labels, F.size(arts).alias("article_count"),
                         prompt.alias("prompt"), md.alias("markdown"))


def write_briefs(briefs: DataFrame, path: str, partition_col: str = "mode") -> None:
    """Brief sink: one text file per mode; a run replaces only its own mode's folder
    (dynamic partition overwrite). A refused (NULL) brief leaves the old file in place."""
    # The text writer ends each row with '\n'; dropping the brief's own final newline
    # first makes the file hold exactly the brief text.
    (briefs.where(F.col("markdown").isNotNull())
        .select(partition_col, F.regexp_replace("markdown", "\n\\z", "").alias("markdown"))
        .repartition(partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col).text(path))


def adaptive_brief_pruned(raw: DataFrame, scored: DataFrame, as_of: str, threshold=MIN_SCORE,
                          allowed: DataFrame | None = None, k: int = TOP_K) -> DataFrame:
    """Single brief that reads only the last 365 days unless that is empty.

    The look-back predicate is applied to ``raw`` before the join, so a table
    partitioned (or sorted) by ingest date prunes its scan. A scalar subquery over the
    recent rows lifts the predicate when no eligible article falls inside 365 days, as
    the reference then asks for all time; nothing runs while the plan is built. Equal to
    ``adaptive_briefs`` over the whole table: a non-empty 365-day set means the all-time
    branch is never chosen.
    """
    horizon = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(WINDOWS_DAYS[-1]))
    recent = [F.coalesce(F.col("ingested_at") >= horizon, F.lit(False))]
    if "ingested_date" in raw.columns:  # implied by the line above; lets a date-partitioned table prune
        recent.append(F.coalesce(F.col("ingested_date") >= F.to_date(horizon), F.lit(False)))

    def eligible(rows: DataFrame) -> DataFrame:
        return eligible_articles(rows, scored, threshold, allowed)

    in_range = raw
    for r in recent:
        in_range = in_range.where(r)
    none = is_empty(eligible(in_range).select("id").limit(1))
    rows = raw
    for r in recent:
        rows = rows.where(r | none)
    return adaptive_briefs(eligible(rows), as_of, k=k)


def read_briefs(spark, path: str, mode: str | None = None) -> DataFrame:
    """Read the brief sink back as ``(mode, format, content)``: the shape the reference serves
    for its latest brief. ``mode`` picks one brief (partition pruning on the mode folder)."""
    df = spark.read.text(path, wholetext=True)
    if mode is not None:
        df = df.where(F.col("mode") == mode)
    return df.select("mode", F.lit("markdown").alias("format"), F.col("value").alias("content"))
