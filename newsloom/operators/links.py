"""Link health of generated briefs: extract URLs, join their fetched status, summarise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import markdown_urls
from .util import HOT_KEY_ROWS, join_hot_split

# Fixed values that must equal the reference's behaviour.
FORBIDDEN_IS_OK = 403


def link_ok(status: Column) -> Column:
    """2xx after redirects, or 403 (sites that block bots) count as reachable; NULL = network error."""
    return F.coalesce(status.between(200, 299) | (status == FORBIDDEN_IS_OK), F.lit(False))


def link_health(briefs: DataFrame, status: DataFrame, key: str = "brief_id", text: str = "markdown",
                hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """One row per (brief, distinct URL in order) with its status; a URL without a status is broken.

    Of several ``status`` rows of one URL the greatest (status, error) counts, a missing status least. A URL cited by more than ``hot_rows``
    briefs is salted across several tasks (``join_hot_split``)."""
    urls = briefs.select(key, F.posexplode(markdown_urls(F.col(text))).alias("pos", "url"))
    st = status.groupBy("url").agg(F.max(F.struct("status", "error")).alias("s")).select("url", "s.status", "s.error")
    j = join_hot_split(urls, st, "url", how="left", hot_rows=hot_rows)
    return j.select(key, "pos", "url", "status", F.coalesce("error", F.lit("no status")).alias("error"),
                    link_ok(F.col("status")).alias("ok"))


def link_health_summary(briefs: DataFrame, status: DataFrame, key: str = "brief_id",
                        text: str = "markdown") -> DataFrame:
    """Per brief: ok_count, url_count, broken URLs in order ('[status] url' / '[ERROR] url'), healthy flag.

    No URLs -> healthy; a missing brief (NULL text) -> unhealthy. Counts are
    partial aggregates; the broken list holds only that brief's own URLs.
    """
    checks = link_health(briefs, status, key, text)
    label = F.concat(F.lit("["), F.coalesce(F.col("status").cast("string"), F.lit("ERROR")), F.lit("] "), F.col("url"))
    agg = checks.groupBy(key).agg(
        F.count_if("ok").alias("ok_count"),
        F.count(F.lit(1)).alias("url_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("pos", label.alias("l"))))),
                                 lambda x: x["l"]), "\n").alias("broken"))
    base = briefs.select(key, F.col(text).isNull().alias("_missing"))
    out = base.join(agg, key, "left")
    return out.select(
        key,
        F.coalesce("ok_count", F.lit(0)).alias("ok_count"),
        F.coalesce("url_count", F.lit(0)).alias("url_count"),
        F.coalesce("broken", F.lit("")).alias("broken"),
        (~F.col("_missing") & (F.coalesce("ok_count", F.lit(0)) == F.coalesce("url_count", F.lit(0)))).alias("healthy"))
