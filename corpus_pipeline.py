"""Corpus pipeline: rejected documents go, one document of each near-duplicate group stays, sources are mixed by
temperature, and the mixture is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; ``run`` writes each stage's
result as Parquet in the shared folder and reads it again for the next. Each stage bounds the session's batches to Python
workers, whose memory an executor carries from stage to stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import minhash, mixing, packing, quality
from newsloom.llm.common import bounded_batches, row_places, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts, with all their columns. It learns from the labelled rows of
    ``docs`` that are not held out; a null or empty text is scored like any other."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = quality.train(docs, labels)
    return quality.score(docs, machine, out="_score").where(F.col("_score") >= 0.5).drop("_score")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at five-word-shingle similarity 0.8 or more: the smallest id's, null ids last and
    ties by a hash of the row. Every row is compared by its own text, also where ids repeat or are null; rows without
    words stay, of those that repeat an id and its text one."""
    bounded_batches(spark)
    key = "_row"
    rows = row_places(docs, key)
    found = minhash.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), width=5).select(
        F.col("doc_id").alias(key), "n_shingles", "component_id")
    found = stored(spark, found, "groups")
    # Narrow rows from here on. The group of a row without words: its id and text; each null id is a document of its own.
    narrow = rows.select(key, "doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(*docs.columns).alias("h2"),
                         F.sha2(F.col("text").cast("binary"), 256).alias("text"))
    group = F.struct(F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("links"),
                     F.when(F.col("n_shingles") == 0, F.col("doc_id")).alias("id"),
                     F.when(F.col("n_shingles") == 0, F.col("text")).alias("text"))
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "h1", "h2", key)
    placed = narrow.join(found, key).where((F.col("n_shingles") > 0) | F.col("doc_id").isNotNull()).select(
        key, group.alias("group"), order.alias("order"))
    best = placed.groupBy("group").agg(F.min("order").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = stored(spark, placed.join(best, placed["group"].eqNullSafe(best["group"])).where("order != best").select(key), "gone")
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture takes them (none is left out, none comes more than twice), written
    in the mixture's order. Null texts and sources take part; repeated rows are taken alike; an empty table stays empty."""
    bounded_batches(spark)
    return mixing.in_mixture_order(mixing.mix(docs)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 token ids, packed along the order in which ``docs`` was
    written: by the number of the file that a row is in, and its place there. A null text is its end id alone, every row
    is packed, an empty table gives no rows."""
    bounded_batches(spark)
    return packing.pack_documents(row_places(docs, "_place"), order="_place")


STAGES = [("quality", quality_stage), ("near_dedup", dedup_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

# The stages need a trained model, hash families and a tokenizer, which SQL can't express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
