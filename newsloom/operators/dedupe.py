"""Duplicate titles: a later article whose lower-cased title was seen before is a duplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .index import KeyIndex
from .util import HOT_KEY_ROWS, join_hot_split, stored


def duplicate_ids(raw: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Ids ``r1.id`` with some ``r2`` where ``lower(r1.title) = lower(r2.title) AND r1.id > r2.id``.

    Same as ``id > min(id) per lower(title)``: a partial (map-side) min and count
    per title, then an equi join back. No pairs are formed. Titles held by more
    than ``hot_rows`` articles are salted across several tasks (``join_hot_split``),
    so a title held by a third of all rows never lands in one task.
    """
    t = raw.where(F.col("title").isNotNull()).select("id", F.lower("title").alias("_tkey"))
    firsts = t.groupBy("_tkey").agg(F.min("id").alias("_first_id"), F.count(F.lit(1)).alias("_n"))
    joined = join_hot_split(t, firsts.drop("_n"), "_tkey", key_counts=firsts.select("_tkey", "_n"), hot_rows=hot_rows)
    return joined.where(F.col("id") > F.col("_first_id")).select("id")


def index_titles(titles: KeyIndex, articles: DataFrame, batch: int) -> None:
    """Adds the titles of ``articles`` (id, title) that ``titles`` does not hold yet, with their first id. Of the index
    only the buckets of these titles are read. Ids grow from batch to batch, so a title that is there keeps its id."""
    firsts = articles.where(F.col("title").isNotNull()).groupBy(F.lower("title").alias("key")).agg(F.min("id").alias("id"))
    if titles.buckets():
        firsts = stored(firsts, "titles")
        firsts = firsts.join(titles.least(firsts, before=batch).select("key"), "key", "left_anti")
    titles.add(firsts, batch)


def duplicates_by_index(articles: DataFrame, titles: KeyIndex, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """:func:`duplicate_ids` among ``articles`` (id, title) against all indexed ones: their titles are looked up, no
    other title is read."""
    t = stored(articles.where(F.col("title").isNotNull()).select("id", F.lower("title").alias("key")), "titles")
    firsts = titles.least(t).select("key", F.col("id").alias("_first_id"))
    joined = join_hot_split(t, firsts, "key", hot_rows=hot_rows)
    return joined.where(F.col("id") > F.col("_first_id")).select("id")


def flag_duplicates(scored: DataFrame, raw: DataFrame, hot_rows: int = HOT_KEY_ROWS, titles: KeyIndex | None = None) -> DataFrame:
    """Set ``is_duplicate`` for scored rows of later twins; never resets a TRUE flag.

    With a ``titles`` index that holds every stored article, ``raw`` only has to hold the articles of ``scored``: a run
    passes its new ones and reads no old title."""
    dups = duplicates_by_index(raw, titles, hot_rows) if titles is not None else duplicate_ids(raw, hot_rows)
    dups = dups.select(F.col("id").alias("_dup_id"))
    j = scored.join(dups, scored["raw_id"] == dups["_dup_id"], "left")
    cols = [c for c in scored.columns if c != "is_duplicate"]
    return j.select(*cols, (F.coalesce(F.col("is_duplicate"), F.lit(False)) | F.col("_dup_id").isNotNull())
                    .alias("is_duplicate")).select(*scored.columns)
