"""Daily summaries answer every brief as the whole tables do, and are updated by days."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from newsloom.operators.brief import adaptive_briefs, eligible_articles
from newsloom.operators.summary import DailyTops
from newsloom.operators.util import shared_folder

BASE = dt.datetime(2024, 1, 31, 12)
RAW = "id long, source string, title string, url string, content string, ingested_at timestamp"


def tables(spark, n=900):
    rng = random.Random(3)
    rows = [(i, f"s{rng.randint(0, 3)}" if i % 50 else None, f"t{i}", f"u{i}", "text",
             BASE - dt.timedelta(hours=rng.randint(-48, 24 * 420)) if i % 40 else None) for i in range(n)]
    scores = [(i, rng.choice([0.5, 0.61, 0.7, 0.7, 0.9, None]), i % 9 == 0) for i in range(n)]
    return (spark.createDataFrame(rows, RAW), spark.createDataFrame(scores, "raw_id long, impact_score float, is_duplicate boolean"))


def picks(df):
    return sorted((r["as_of"], r["source"] or "", r["rank"], r["id"], r["window_days"] or 0) for r in df.collect())


def briefs(rows, as_ofs):
    rows = rows.withColumn("as_of", F.explode(F.array(*[F.lit(a).cast("timestamp") for a in as_ofs])))
    return adaptive_briefs(rows, F.col("as_of"), group_cols=["source", "as_of"])


def test_equal_to_the_whole_tables(spark):
    raw, scored = tables(spark)
    daily = DailyTops(spark, shared_folder(spark, "t-daily"))
    assert daily.read().count() == 0
    daily.update(raw, scored.where("raw_id < 500"), raw.where("id < 500").select("id"))
    daily.update(raw, scored, raw.where("id >= 500").select("id"))
    as_ofs = ["2024-01-31", "2024-01-31 13:30:00", "2024-02-20 07:00:00", "2025-01-20", "2027-01-01", "2027-01-01 01:00:00"]
    got = daily.rows(as_ofs, raw, scored)
    assert picks(briefs(got, as_ofs)) == picks(briefs(eligible_articles(raw, scored), as_ofs))
    allowed = spark.createDataFrame([("s1",), ("s2",)], "source string")
    for as_of in as_ofs:
        one = adaptive_briefs(daily.rows([as_of], raw, scored, 0.65, allowed), as_of)
        want = adaptive_briefs(eligible_articles(raw, scored, 0.65, allowed), as_of)
        assert sorted((r["rank"], r["id"]) for r in one.collect()) == sorted((r["rank"], r["id"]) for r in want.collect())
    # Full days need no article at all.
    plan = daily.rows(["2024-01-31"], raw, scored)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "content" not in plan


def test_updates_touch_only_their_days(spark):
    raw, scored = tables(spark, 300)
    path = shared_folder(spark, "t-daily")
    daily = DailyTops(spark, path)
    daily.update(raw, scored, raw.select("id"))
    local = path.removeprefix("file:")
    files = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(local) for f in fs if f.endswith(".parquet")}
    best = daily.read().where("day is not null").orderBy(F.col("impact_score").desc(), "id").first()
    flagged = scored.withColumn("is_duplicate", F.col("is_duplicate") | (F.col("raw_id") == best["id"]))
    daily.update(raw, flagged, spark.createDataFrame([(best["id"],)], "id long"))
    assert daily.read().where(F.col("id") == best["id"]).count() == 0
    kept = [f for f in files if f"day={best['day']}" not in f]
    assert kept and all(os.path.getmtime(f) == files[f] for f in kept)
    as_ofs = ["2024-01-31", "2025-06-01"]
    assert picks(briefs(daily.rows(as_ofs, raw, flagged), as_ofs)) == picks(briefs(eligible_articles(raw, flagged), as_ofs))
    none = scored.withColumn("is_duplicate", F.lit(True))
    daily.update(raw, none, raw.select("id"))
    assert daily.read().count() == 0
    daily.update(raw, none, raw.where("false").select("id"))
