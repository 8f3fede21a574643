"""Command-line run: ``python -m newsloom --mode weekly --as-of 2024-01-31 --catalog DIR --payloads P --out OUT``.

Reads the previous snapshots of the articles and scored tables (if given),
runs collect -> classify -> dedupe -> generate -> link health for one mode, and
writes new snapshots to ``OUT`` (never over its own inputs):

* ``OUT/raw``     articles, partitioned by ``ingested_date`` (the look-back filter prunes by it)
* ``OUT/scored``  scored table
* ``OUT/briefs``  one Markdown file per mode
* ``OUT/health``  link-health summary
* ``OUT/requests`` with ``--answers``: the URLs to fetch next

With ``--in-place`` the ``--raw`` (partitioned by ``ingested_date``) and
``--scored`` tables are updated where they are instead: new scores are
appended (new articles get larger ids, so they never turn a stored score into
a duplicate) and only the date partitions holding new or rewritten articles
are replaced. The work then grows with the new data, not with the table.

The exit status is 1 when the brief has broken links, as in the reference.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .operators.ingest import RAW_TYPES, conform_raw
from .operators.score import SCORED_COLUMNS

SCORED_SCHEMA = "raw_id BIGINT, db_engine STRING, topic STRING, impact_score FLOAT, is_duplicate BOOLEAN"
RAW_SCHEMA = ", ".join(f"{k} {v}" for k, v in RAW_TYPES.items())
PAYLOAD_SCHEMA = "source STRING, feed_url STRING, source_ord INT, body STRING"


def _read(spark, path, schema):
    if path:
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="newsloom")
    ap.add_argument("--mode", default="weekly")
    ap.add_argument("--as-of", required=True, help="run time, e.g. 2024-01-31 or 2024-01-31 06:00:00")
    ap.add_argument("--catalog", required=True, help="folder or file of catalog JSON documents (v2 or legacy)")
    ap.add_argument("--answers", help="parquet: url, ok, body, error[, content_encoding]: a crawler's results, used for the "
                                      "feeds of the catalog instead of --payloads")
    ap.add_argument("--templates", help="folder of <name>.txt prompt templates (article_weekly, article_ai_radar, ...)")
    ap.add_argument("--daily", help="folder of the daily summaries (kept from run to run; briefs are answered from them)")
    ap.add_argument("--titles", help="folder of the title index (kept from run to run; built on its first use)")
    ap.add_argument("--payloads", help="parquet: source, feed_url, source_ord, body (text or binary)")
    ap.add_argument("--raw", help="parquet snapshot of the articles table from the previous run")
    ap.add_argument("--scored", help="parquet snapshot of the scored table from the previous run")
    ap.add_argument("--responses", help="parquet: raw_id, response (model answers); missing -> offline answer")
    ap.add_argument("--link-status", help="parquet: url, status, error")
    ap.add_argument("--feed-status", help="parquet: feed_url, status (enables the feed health check)")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    ap.add_argument("--in-place", action="store_true",
                    help="update --raw and --scored where they are (only touched date partitions are rewritten)")
    args = ap.parse_args(argv)

    from .plans.jobs import run_mode
    from .session import build_session
    from .sources.catalog import read_catalog
    from .sources.fetch import fetch_rounds, selected_feeds
    from .sources.templates import read_templates
    from .operators.index import KeyIndex
    from .operators.summary import DailyTops
    from .operators.brief import write_briefs

    spark = build_session(args.master)
    raw = conform_raw(_read(spark, args.raw, RAW_SCHEMA), args.as_of)
    scored = _read(spark, args.scored, SCORED_SCHEMA).select(*SCORED_COLUMNS)
    responses = spark.read.parquet(args.responses) if args.responses else None
    links = _read(spark, args.link_status, "url STRING, status INT, error STRING")
    feed_status = spark.read.parquet(args.feed_status) if args.feed_status else None
    catalog = read_catalog(spark, args.catalog)
    answers = spark.read.parquet(args.answers) if args.answers else None
    payloads = None if args.answers else _read(spark, args.payloads, PAYLOAD_SCHEMA)
    result = run_mode(raw, scored, responses, catalog, payloads, links, args.mode, args.as_of, feed_status=feed_status,
                      answers=answers, titles=KeyIndex(spark, args.titles) if args.titles else None,
                      templates=read_templates(spark, args.templates) if args.templates else None,
                      daily=DailyTops(spark, args.daily) if args.daily else None)
    if answers is not None:
        feeds = selected_feeds(catalog, args.mode)
        fetch_rounds(feeds, answers).pending.write.mode("overwrite").parquet(f"{args.out}/requests")

    write_briefs(result.brief, f"{args.out}/briefs")
    result.health.write.mode("overwrite").parquet(f"{args.out}/health")
    if args.in_place and args.raw and args.scored:
        _update_in_place(spark, args, raw, result)
    else:
        (result.raw.withColumn("ingested_date", F.to_date("ingested_at"))  # (re)derived for every row
            .write.mode("overwrite").partitionBy("ingested_date").parquet(f"{args.out}/raw"))
        result.scored.write.mode("overwrite").parquet(f"{args.out}/scored")
    healthy = spark.read.parquet(f"{args.out}/health").where("NOT healthy").isEmpty()
    return 0 if healthy else 1


def _update_in_place(spark, args, raw, result) -> None:
    """Append new scores; replace only the date partitions that hold new or rewritten articles.

    Everything written is first materialised (checkpoint), so nothing still reads
    the partitions being replaced.
    """
    from .session import checkpoint_dir
    checkpoint_dir(spark)
    new_scores = result.new_scores.checkpoint(eager=True)
    new_rows = result.new_rows.withColumn("ingested_date", F.to_date("ingested_at"))
    rewritten = result.rewritten.withColumnRenamed("url", "_new_url")
    with_date = raw.withColumn("ingested_date", F.coalesce("ingested_date", F.to_date("ingested_at"))) \
        if "ingested_date" in raw.columns else raw.withColumn("ingested_date", F.to_date("ingested_at"))
    touched = (new_rows.select("ingested_date")
               .unionByName(with_date.join(rewritten, "id", "left_semi").select("ingested_date")).distinct())
    kept = with_date.join(touched, "ingested_date", "left_semi")
    kept = kept.join(rewritten, "id", "left").withColumn(
        "url", F.coalesce("_new_url", "url")).drop("_new_url")
    cols = list(RAW_TYPES) + ["ingested_date"]
    changed = kept.select(*cols).unionByName(new_rows.select(*cols)).checkpoint(eager=True)
    # Articles first, scores second: if the run stops in between, the next run finds the
    # new articles unscored and scores them; scores never point at articles not stored.
    (changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingested_date").parquet(args.raw))
    new_scores.write.mode("append").parquet(args.scored)


if __name__ == "__main__":
    sys.exit(main())
