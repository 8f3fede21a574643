"""Continuous ingest: payload files -> decode -> parse -> rewrites and first item per URL -> append, once per URL.

Uniqueness is kept by a URL index (``operators.index``): a batch looks its own URLs up in their buckets and takes the
last id from the index's summary, so it reads nothing of the stored articles, however many there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.index import KeyIndex
from ..operators.ingest import assign_ids, feed_items, first_per_url, repaired_links, valid_items
from ..operators.util import lookup_join, stored
from ..sources.feeds import healthy_feeds

# Bodies are bytes (gzip, any declared encoding) or text, which reads as its UTF-8 bytes.
PAYLOAD_SCHEMA = "source STRING, feed_url STRING, source_ord INT, body BINARY, content_encoding STRING"
STORED_SCHEMA = ("id BIGINT, source STRING, title STRING, url STRING, published_at STRING, content STRING, "
                 "ingested_at TIMESTAMP, batch_id BIGINT")
REWRITE_SCHEMA = "id BIGINT, url_before STRING, url STRING, batch_id BIGINT"


def rewrites_path(sink: str) -> str:
    return f"{sink.rstrip('/')}-rewrites"


def url_index(spark: SparkSession, sink: str) -> KeyIndex:
    return KeyIndex(spark, f"{sink.rstrip('/')}-urls")


def _identity():
    """What a rewrite has to find unchanged besides the URL."""
    return F.xxhash64("source", "title")


def _entries(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("url").alias("key"), "id", _identity().alias("mark"), F.lit(True).alias("alive"))


def ingest_batch(spark: SparkSession, batch: DataFrame, batch_id: int, sink: str, urls: KeyIndex, as_of,
                 feed_status: DataFrame | None = None) -> None:
    """One micro-batch: new articles under ``sink``, changed URLs of stored ones under ``<sink>-rewrites``, both in
    ``batch_id=<id>``, and the index entries of both.

    A replayed batch sees the index as it was before it and replaces its own output and entries, so a failure at any
    point adds nothing twice. ``feed_status`` (feed_url, status) drops the items of feeds that aren't healthy."""
    if feed_status is not None:
        batch = healthy_feeds(batch, feed_status)
    items = stored(valid_items(feed_items(batch)), "items")
    links = repaired_links(items)
    keys = items.select(F.col("link").alias("key")).unionByName(links.select(F.col("original_link").alias("key")))
    known = stored(urls.latest(keys, before=batch_id), "known-urls")
    taken = known.select("key")
    changes = links.join(taken, F.col("new_url") == F.col("key"), "left_anti").withColumn("_mark", _identity())
    changes = stored(changes.join(known, (F.col("original_link") == F.col("key")) & (F.col("_mark") == F.col("mark"))).select(
        "id", "original_link", "new_url", F.col("_mark").alias("mark")), "rewrites")
    taken = taken.join(changes.select(F.col("original_link").alias("key")), "key", "left_anti").unionByName(
        changes.select(F.col("new_url").alias("key")))
    fresh = first_per_url(items).join(taken, F.col("url") == F.col("key"), "left_anti")
    _, last = urls.summary(before=batch_id)
    rows = assign_ids(fresh, ["source_ord", "item_ord"], F.lit(last or 0).cast("bigint"))
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    out = rows.select("id", "source", "title", "url", F.col("published").alias("published_at"), "content",
                      as_of_col.alias("ingested_at"))
    out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    (changes.select("id", F.col("original_link").alias("url_before"), F.col("new_url").alias("url"))
        .write.mode("overwrite").parquet(f"{rewrites_path(sink)}/batch_id={batch_id}"))
    written = spark.read.schema(STORED_SCHEMA.rsplit(",", 1)[0]).parquet(f"{sink}/batch_id={batch_id}")
    moved = changes.select(F.col("new_url").alias("key"), "id", "mark", F.lit(True).alias("alive")).unionByName(
        changes.select(F.col("original_link").alias("key"), "id", "mark", F.lit(False).alias("alive")))
    urls.add(_entries(written).unionByName(moved), batch_id)


def start_ingest_stream(spark: SparkSession, payload_dir: str, sink: str, checkpoint: str,
                        seed: DataFrame | None = None, as_of=None, files_per_batch: int = 1,
                        available_now: bool = True, feed_status: DataFrame | None = None):
    """Start the stream (parquet payload files in ``payload_dir``); returns the StreamingQuery.

    The articles of ``seed`` count as stored: they are indexed once, when the index is first made. ``feed_status`` is a
    static table that each batch is joined with."""
    urls = url_index(spark, sink)
    if seed is not None and not urls.buckets():
        urls.add(_entries(seed), -1)
    stream = (spark.readStream.schema(PAYLOAD_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
              .parquet(payload_dir))
    as_of = as_of if as_of is not None else F.current_timestamp()
    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, bid: ingest_batch(spark, df, bid, sink, urls, as_of, feed_status)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_rewrites(spark: SparkSession, sink: str) -> DataFrame:
    """The last rewrite of each article, of the stream's own and of the seed: (id, url)."""
    rows = spark.read.schema(REWRITE_SCHEMA).parquet(rewrites_path(sink))
    return rows.groupBy("id").agg(F.max_by("url", "batch_id").alias("url"))


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The stream's articles with their present URLs."""
    rows = spark.read.schema(STORED_SCHEMA).parquet(sink)
    changed = read_rewrites(spark, sink).withColumnRenamed("url", "_new")
    return lookup_join(rows, changed, "id", "left").select(
        *[F.coalesce("_new", "url").alias("url") if c == "url" else F.col(c) for c in rows.columns])
