"""Incremental runs read and compute only what is new."""

import datetime as dt

from pyspark.sql import functions as F

from newsloom.operators import score as S
from newsloom.operators.ingest import RAW_TYPES
from newsloom.operators.util import shared_folder
from newsloom.sources.catalog import parse_catalog

AS_OF = dt.datetime(2024, 1, 31)
CATALOG = ('{"version": "2.0", "domains": {"d": {"weight": 1.0, "tags": ["sql", "index scan"], "sources": ['
           '{"name": "s1", "url": "u", "weight": 0.5}]}}}')


def articles(spark, path, n=400, per_file=40):
    """A stored articles table, ids 1..n in order, ``per_file`` rows in each file and a date for each file."""
    rows = [(i, f"s{i % 3}", f"t{i}", f"u{i}", None, f"sql text {i} " * 50, AS_OF - dt.timedelta(days=(n - i) // per_file))
            for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} {v}" for k, v in RAW_TYPES.items()))
    df.repartitionByRange(n // per_file, "id").write.parquet(path)
    return spark.read.parquet(path)


def scan_rows(df, column):
    """Rows that the executed plan's file scans with ``column`` put out, and their text."""
    df.collect()
    found, texts, todo = 0, [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if "Scan parquet" in node.nodeName() and column in node.schema().fieldNames():
            found += node.metrics().apply("numOutputRows").value()
            texts.append(node.toString())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found, texts


def scores(df):
    return {r["raw_id"]: r["impact_score"] for r in df.collect()}


def test_only_unscored_texts_are_read(spark):
    raw = articles(spark, shared_folder(spark, "t-raw"))
    catalog = parse_catalog(spark.createDataFrame([(0, CATALOG)], "doc_ord int, value string"))
    scored = raw.where("id <= 360").select(F.col("id").alias("raw_id"))
    got = S.score_articles(raw, scored, None, catalog)
    rows, scans = scan_rows(got, "content")
    assert rows == 40 and "PushedFilters" in scans[0] and "GreaterThanOrEqual(id,361)" in scans[0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" not in plan  # the anti join ran before, on narrow rows
    whole = scores(S.score_articles(raw, None, None, catalog))
    assert scores(got) == {i: v for i, v in whole.items() if i > 360} and len(whole) == 400


def test_many_unscored_ids_are_not_broadcast(spark, monkeypatch):
    raw = articles(spark, shared_folder(spark, "t-raw"))
    catalog = parse_catalog(spark.createDataFrame([(0, CATALOG)], "doc_ord int, value string"))
    scored = raw.where("id % 2 = 0 and id > 40").select(F.col("id").alias("raw_id"))
    few = scores(S.score_articles(raw, scored, None, catalog))
    monkeypatch.setattr(S, "BROADCAST_IDS", 10)
    assert scores(S.score_articles(raw, scored, None, catalog)) == few and len(few) == 220
    allowed = spark.createDataFrame([("s1",)], "source string")
    assert set(scores(S.score_articles(raw, scored, None, catalog, "weekly", allowed))) == {i for i in few if i % 3 == 1}


def test_scan_lists_only_the_dates_of_unscored_articles(spark):
    path = shared_folder(spark, "t-raw")
    raw = articles(spark, shared_folder(spark, "t-raw"))
    raw.withColumn("ingested_date", F.when(F.col("id") < 390, F.to_date("ingested_at"))).write.partitionBy("ingested_date").parquet(path)
    dated = spark.read.parquet(path)
    catalog = parse_catalog(spark.createDataFrame([(0, CATALOG)], "doc_ord int, value string"))
    scored = raw.where("id not in (50, 395)").select(F.col("id").alias("raw_id"))  # 395: no date
    got = S.score_articles(dated, scored, None, catalog)
    rows, scans = scan_rows(got, "content")
    assert rows <= 40 + 11 and "ingested_date" in scans[0].split("PartitionFilters")[1]
    assert set(scores(got)) == {50, 395}


def test_nothing_unscored(spark):
    raw = articles(spark, shared_folder(spark, "t-raw"), 80)
    catalog = parse_catalog(spark.createDataFrame([(0, CATALOG)], "doc_ord int, value string"))
    assert S.score_articles(raw, raw.select(F.col("id").alias("raw_id")), None, catalog).count() == 0
    with_null = raw.where("id < 5").select(F.when(F.col("id") > 1, F.col("id")).alias("raw_id"))
    assert S.score_articles(raw, with_null, None, catalog).count() == 0
