"""Daily summaries: the best articles of every day and source, from which any brief window is answered.

A window's top k is the top k of its days' top k, and a score threshold takes rows off the end of that order, so the
summaries are kept without one. A source's rows are kept apart, so any selection of sources can be answered too. The
table has at most k rows per day and source and carries no article text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .brief import MIN_SCORE, TOP_K, WINDOWS_DAYS, eligible_articles
from .score import filter_sources
from .util import stored

ROWS = "id BIGINT, source STRING, title STRING, url STRING, ingested_at TIMESTAMP, impact_score FLOAT, day DATE"


def _day(df: DataFrame):
    """The day a row belongs to (NULL without an ingest time); a date-partitioned table keeps its own column."""
    return F.coalesce("ingested_date", F.to_date("ingested_at")) if "ingested_date" in df.columns else F.to_date("ingested_at")


def _of_days(raw: DataFrame, days: list) -> DataFrame:
    """Rows of these days; the filter on a partition column prunes the scan."""
    known = [d for d in days if d is not None]

    def among(c):
        hit = F.coalesce(c.isin(known), F.lit(False)) if known else F.lit(False)
        return hit | c.isNull() if len(known) < len(days) else hit
    if "ingested_date" in raw.columns:
        raw = raw.where(among(F.col("ingested_date")) | F.col("ingested_date").isNull())
    return raw.where(among(_day(raw)))


class DailyTops:
    """The summaries under ``path``, one folder per day."""

    def __init__(self, spark: SparkSession, path: str, k: int = TOP_K):
        self.spark, self.path, self.k = spark, path.rstrip("/"), k

    def empty(self) -> bool:
        """Whether no day has been made yet."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def read(self) -> DataFrame:
        if self.empty():
            return self.spark.createDataFrame([], ROWS)
        # The folder of rows without a day is Spark's default partition, which reads back as NULL.
        return self.spark.read.schema(ROWS).parquet(self.path)

    def update(self, raw: DataFrame, scored: DataFrame, changed: DataFrame) -> None:
        """Makes the days anew that hold ``changed`` articles (id): newly scored or flagged ones, and ones with another
        URL. ``raw`` and ``scored`` are the whole tables; only these days' articles are read, and other days' folders
        stay as they are. A day whose articles are no longer eligible becomes empty."""
        dated = raw.select("id", _day(raw).alias("day"))
        touched = [r[0] for r in dated.join(changed.select("id"), "id", "left_semi").select("day").distinct().collect()]
        if not touched:
            return
        best = Window.partitionBy("day", "source").orderBy(F.col("impact_score").desc(), F.col("id").asc())
        rows = eligible_articles(_of_days(raw, touched), scored, float("-inf")).withColumn("day", F.to_date("ingested_at"))
        top = rows.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= self.k).drop("_rn")
        top = stored(top.select(*[c.split()[0] for c in ROWS.split(", ")]), "daily")
        left = {r[0] for r in top.select("day").distinct().collect()}
        (top.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path))
        for day in set(touched) - left:
            name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/day={name}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def rows(self, as_ofs, raw: DataFrame, scored: DataFrame, threshold=MIN_SCORE, allowed: DataFrame | None = None) -> DataFrame:
        """Rows (as :func:`brief.eligible_articles` gives them) from which ``adaptive_briefs`` answers the windows of
        every ``as_of`` (timestamp texts) as from all eligible articles.

        A window that begins within a day needs more of that day than its best: those days' articles (five per as_of
        that isn't midnight) are read from the tables instead."""
        split = set()
        for as_of in as_ofs:
            end = dt.datetime.fromisoformat(as_of)
            if end.time() != dt.time():
                split |= {(end - dt.timedelta(days=d)).date() for d in WINDOWS_DAYS}
        columns = [c.split()[0] for c in ROWS.split(", ") if not c.startswith("day")]
        rows = self.read()
        if split:
            rows = rows.where(~F.coalesce(F.col("day").isin(sorted(split)), F.lit(False)))
        rows = filter_sources(rows.where(F.col("impact_score") >= (F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold))
                              .select(*columns), allowed)
        if split:
            rows = rows.unionByName(eligible_articles(_of_days(raw, sorted(split)), scored, threshold, allowed).select(*columns))
        return rows
