"""Ingest: feed items -> valid items -> URL rewrite -> insert-if-absent with new ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import memo_column
from ..functions.text import repair_link, resolve_link
from ..session import checkpoint_dir
from .util import lookup_join, stored
from ..sources.feeds import decode_payload, parse_feed

RAW_COLUMNS = ["id", "source", "title", "url", "published_at", "content", "ingested_at"]
ITEM_ORDER = ("source_ord", "item_ord")


def feed_items(payloads: DataFrame, body_col: str = "body") -> DataFrame:
    """Payloads ``(source, feed_url, source_ord, body)`` -> parsed items (rejected feeds give none)."""
    body = F.col(body_col)
    encoding = F.col("content_encoding") if "content_encoding" in payloads.columns else None
    text = decode_payload(body, encoding) if dict(payloads.dtypes)[body_col] == "binary" else body
    parsed = parse_feed(payloads.withColumn("_text", text).drop(body_col), text_col="_text")
    return parsed.where(F.col("item_ord").isNotNull())


def valid_items(items: DataFrame) -> DataFrame:
    """Resolve relative links against the feed URL, repair truncated links from the content, and
    keep items whose title and link are both non-empty (untrimmed).

    ``original_link`` is the resolved link before repair (needed by :func:`rewrite_urls`).
    """
    resolved = memo_column("resolve_link", lambda: resolve_link(F.col("link"), F.col("feed_url")))
    df = items.withColumn("original_link", resolved)
    df = df.withColumn("link", memo_column("repair_link",
                                           lambda: repair_link(F.col("original_link"), F.col("content"))))
    return df.where((F.col("title") != "") & (F.col("link") != ""))


def first_per_url(items: DataFrame, order=ITEM_ORDER) -> DataFrame:
    """One item per URL: the first in (source order, item order), whatever its title.

    A ``min_by`` aggregate, so map tasks pre-reduce: a URL repeated in a third of
    all items still ships one row per map task.
    """
    cols = [c for c in items.columns if c != "link"]
    agg = items.groupBy(F.col("link").alias("url")).agg(
        F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
    return agg.select("url", *[F.col(f"_first.{c}").alias(c) for c in cols])


def assign_ids(df: DataFrame, order_cols, start_after: Column, id_col: str = "id",
               num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``start_after + 1, +2, ...`` in ``order_cols`` order, without a global window.

    Rows are range-partitioned and sorted on the order key, then checkpointed to
    the shared checkpoint folder so partition contents cannot change between the
    count and the numbering. Each row's id is its partition's offset (prefix sum
    of per-partition counts: a table with one row per partition) plus its
    position in the partition (from ``monotonically_increasing_id``).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    frozen = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).checkpoint(eager=True)
    tagged = frozen.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition (n rows), so this ordered window stays tiny.
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    joined = tagged.join(F.broadcast(offsets), "_pid")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return joined.withColumn(id_col, F.coalesce(start_after, F.lit(0)) + F.col("_off") + pos + 1) \
        .drop("_pid", "_mid", "_off")


def repaired_links(items: DataFrame) -> DataFrame:
    """One rewrite per repaired link: (source, title, original_link, new_url). Two rewrites onto one URL keep the first
    item's."""
    cand = items.where((F.col("link") != F.col("original_link")) & (F.col("original_link") != ""))
    firsts = cand.groupBy("source", "title", "original_link").agg(
        F.min_by(F.col("link"), F.struct(*ITEM_ORDER)).alias("new_url"),
        F.min(F.struct(*ITEM_ORDER)).alias("_ord"))
    per_url = firsts.groupBy("new_url").agg(F.min_by(F.struct("source", "title", "original_link"), F.col("_ord"))
                                            .alias("k"))
    return per_url.select("k.source", "k.title", "k.original_link", "new_url")


def rewrite_changes(raw: DataFrame, items: DataFrame) -> DataFrame:
    """``(id, new_url)``: stored rows with the same (source, title, original link) as an item whose link was repaired.
    A rewrite onto a URL that already exists is skipped (URLs stay unique). Reads narrow columns of ``raw`` only."""
    rw = repaired_links(items).select(F.col("source").alias("_s"), F.col("title").alias("_t"),
                                      F.col("original_link").alias("_o"), "new_url")
    existing = raw.select(F.col("url").alias("_existing"))
    rw = rw.join(existing, rw["new_url"] == existing["_existing"], "left_anti")
    keys = raw.select("id", "source", "title", "url")
    hits = keys.join(rw, (keys["source"] == rw["_s"]) & (keys["title"] == rw["_t"]) & (keys["url"] == rw["_o"]))
    return hits.select("id", "new_url")


def with_changes(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """``rows`` (id, url, ...) with the URLs of ``changes`` (id, new_url). The wide rows are only shuffled where the
    changes are too many to broadcast."""
    joined = lookup_join(rows, changes, "id", "left")
    return joined.select(*[F.coalesce(F.col("new_url"), F.col("url")).alias("url") if c == "url" else F.col(c) for c in rows.columns])


def rewrite_urls(raw: DataFrame, items: DataFrame) -> DataFrame:
    """``raw`` with the URLs of :func:`rewrite_changes`, and a ``url_before`` column."""
    return with_changes(raw.withColumn("url_before", F.col("url")), rewrite_changes(raw, items)).select(*raw.columns, "url_before")


def new_articles(raw: DataFrame, items: DataFrame, changes: DataFrame, as_of) -> DataFrame:
    """:func:`ingest_new` for ``raw`` with stored ``changes``, without applying these to the table: a URL is taken if
    a stored row has it and is not rewritten, or if a rewrite leads to it."""
    firsts = first_per_url(items)
    own = firsts.select(F.col("url").alias("_u"))
    held = raw.select("id", F.col("url").alias("_stored")).join(own, F.col("_stored") == F.col("_u"), "left_semi")
    taken = held.join(changes.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_anti").select("_stored")
    taken = taken.unionByName(changes.select(F.col("new_url").alias("_stored")))
    fresh = firsts.join(taken, firsts["url"] == taken["_stored"], "left_anti")
    return _numbered(fresh, raw.select(F.max("id")).scalar(), as_of)


def _numbered(fresh: DataFrame, start: Column, as_of) -> DataFrame:
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    numbered = assign_ids(fresh, list(ITEM_ORDER), start)
    return numbered.select("id", "source", "title", "url", F.col("published").alias("published_at"), "content",
                           as_of_col.alias("ingested_at"))


def ingest_new(raw: DataFrame, items: DataFrame, as_of) -> DataFrame:
    """New ``articles_raw`` rows: first item per URL, minus URLs already stored, numbered after
    the largest stored id, stamped with ``as_of``."""
    firsts = first_per_url(items)
    known = raw.select(F.col("url").alias("_stored"))
    fresh = firsts.join(known, firsts["url"] == known["_stored"], "left_anti")
    return _numbered(fresh, raw.select(F.max("id")).scalar(), as_of)


def collected_items(payloads: DataFrame, feed_status: DataFrame | None = None, answers: DataFrame | None = None) -> DataFrame:
    """Valid items of the (healthy) feeds, stored: the feeds are parsed once.

    ``payloads`` holds the feeds' bodies; with ``answers`` (a crawler's results by URL) only their source, feed_url and
    source_ord are used, and each feed's body comes from its fetch rounds (``sources.fetch``)."""
    from ..sources.feeds import healthy_feeds
    if feed_status is not None:
        payloads = healthy_feeds(payloads, feed_status)
    if answers is not None:
        from ..sources.fetch import FEED, fetch_rounds
        parsed = fetch_rounds(payloads.select(*FEED), answers).items.where(F.col("item_ord").isNotNull())
    else:
        parsed = feed_items(payloads)
    return stored(valid_items(parsed), "items")


def collect(raw: DataFrame, payloads: DataFrame, as_of, feed_status: DataFrame | None = None,
            answers: DataFrame | None = None) -> tuple:
    """The collect job: (healthy feeds) -> fetch rounds or payloads -> parse -> valid items -> URL rewrite ->
    insert-if-absent (see :func:`collected_items`).

    Returns ``(raw_after_rewrite, new_rows)``; the caller appends ``new_rows``.
    """
    items = collected_items(payloads, feed_status, answers)
    changes = stored(rewrite_changes(raw, items), "rewrites")
    return with_changes(raw, changes), new_articles(raw, items, changes, as_of)


RAW_TYPES = {"id": "bigint", "source": "string", "title": "string", "url": "string", "published_at": "string",
             "content": "string", "ingested_at": "timestamp"}


def conform_raw(df: DataFrame, as_of) -> DataFrame:
    """Bring a stored articles table to the current schema: missing columns are added (the
    ingest time is back-filled with ``as_of``, like a column added with a NOW() default),
    and columns are put in order with their types. A partition column ``ingested_date``
    is kept so that date filters can prune the scan."""
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    cols = []
    for name, typ in RAW_TYPES.items():
        if name in df.columns:
            cols.append(F.col(name).cast(typ).alias(name))
        elif name == "ingested_at":
            cols.append(as_of_col.alias(name))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    if "ingested_date" in df.columns:
        cols.append(F.col("ingested_date"))
    return df.select(*cols)
