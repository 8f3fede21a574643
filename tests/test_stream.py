"""The stream's batches: uniqueness by the URL index, rewrites, replays, payload encodings, feed health."""

import gzip

from pyspark.sql import functions as F

from newsloom.operators.util import shared_folder
from newsloom.streaming.ingest_stream import ingest_batch, read_rewrites, read_sink, start_ingest_stream, url_index

from test_incremental import scan_rows

PAYLOAD = "source string, feed_url string, source_ord int, body binary, content_encoding string"


def feed(*items):
    return "<rss><channel>" + "".join(f"<item><title>{t}</title><link>{u}</link><description>{c}</description></item>"
                                      for t, u, c in items) + "</channel></rss>"


def payload(spark, *feeds):
    return spark.createDataFrame([(s, f"https://{s}/feed", i, b if isinstance(b, bytes) else b.encode(), None)
                                  for i, (s, b) in enumerate(feeds)], PAYLOAD)


def rows(spark, sink):
    return sorted((r["id"], r["title"], r["url"]) for r in read_sink(spark, sink).collect())


def test_batches_add_and_rewrite(spark):
    sink = shared_folder(spark, "t-sink")
    urls = url_index(spark, sink)
    seed = spark.createDataFrame([(10, "s", "Old", "https://s/old"), (11, "s", "Cut", "https://s/cut")], "id long, source string, title string, url string")
    urls.add(seed.select(F.col("url").alias("key"), "id", F.xxhash64("source", "title").alias("mark")), -1)
    one = payload(spark, ("s", feed(("A", "https://s/a", "x"), ("Old again", "https://s/old", "x"), ("B", "https://s/b", "x"))))
    ingest_batch(spark, one, 0, sink, urls, "2024-01-31")
    assert rows(spark, sink) == [(12, "A", "https://s/a"), (13, "B", "https://s/b")]
    # A stored article's cut link is repaired; another title with the cut link is not the same article.
    two = payload(spark, ("s", feed(("Cut", "https://s/cut", "https://s/cut-full"), ("A", "https://s/a", "https://s/a-full"),
                                    ("Other", "https://s/b", "https://s/b-full"), ("New", "https://s/n", "x"))))
    for _ in range(2):  # and the batch again, as after a failure
        ingest_batch(spark, two, 1, sink, urls, "2024-01-31")
        assert rows(spark, sink) == [(12, "A", "https://s/a-full"), (13, "B", "https://s/b"), (14, "Other", "https://s/b-full"),
                                     (15, "New", "https://s/n")]
        assert sorted(map(tuple, read_rewrites(spark, sink).collect())) == [(11, "https://s/cut-full"), (12, "https://s/a-full")]
    # The rewritten URLs are taken, the old ones are free again.
    three = payload(spark, ("s", feed(("X", "https://s/cut-full", "x"), ("Y", "https://s/cut", "x"), ("Cut", "https://s/cut", "https://s/cut-full"))))
    ingest_batch(spark, three, 2, sink, urls, "2024-01-31")
    assert rows(spark, sink)[4:] == [(16, "Y", "https://s/cut")]
    ingest_batch(spark, payload(spark), 3, sink, urls, "2024-01-31")
    assert len(rows(spark, sink)) == 5


def test_first_replay_of_an_interrupted_batch(spark):
    """A batch whose index entries are missing (it stopped before them) writes the same rows again."""
    sink = shared_folder(spark, "t-sink")
    urls = url_index(spark, sink)
    one = payload(spark, ("s", feed(("A", "https://s/a", "x"))), ("t", feed(("A2", "https://s/a", "x"), ("B", "https://s/b", "x"))))
    spark.createDataFrame([(99, "s", "torn", "https://s/torn", None, None, None)],
                          "id long, source string, title string, url string, published_at string, content string, ingested_at timestamp"
                          ).write.parquet(f"{sink}/batch_id=0")
    ingest_batch(spark, one, 0, sink, urls, "2024-01-31")
    assert rows(spark, sink) == [(1, "A", "https://s/a"), (2, "B", "https://s/b")]


def test_encodings_and_health(spark):
    root = shared_folder(spark, "t-stream")
    body = feed(("Café", "https://s/1", "x"))
    packed = [("u8", body.encode()), ("gz", gzip.compress(body.replace("/1", "/2").encode())),
              ("u16", body.replace("/1", "/3").encode("utf-16")), ("latin", ('<?xml version="1.0" encoding="ISO-8859-1"?>'
               + body.replace("/1", "/4")).encode("latin-1")), ("ill", body.replace("/1", "/5").encode()), ("bad", b"\x00\xff")]
    payload(spark, *packed).coalesce(2).write.parquet(f"{root}/in")
    status = spark.createDataFrame([(f"https://{s}/feed", 500 if s == "ill" else 200) for s, _ in packed], "feed_url string, status int")
    q = start_ingest_stream(spark, f"{root}/in", f"{root}/sink", f"{root}/ckpt", as_of="2024-01-31", feed_status=status)
    q.awaitTermination()
    got = rows(spark, f"{root}/sink")
    assert sorted(r[2] for r in got) == [f"https://s/{k}" for k in (1, 2, 3, 4)] and {r[1] for r in got} == {"Café"}
    assert sorted(r[0] for r in got) == [1, 2, 3, 4]


def test_a_batch_reads_its_own_buckets(spark):
    """Index rows read for one URL do not grow with the number of stored articles."""
    sink = shared_folder(spark, "t-sink")
    urls = url_index(spark, sink)
    urls.bucket_rows = 100
    read = []
    for k, n in enumerate((500, 1500, 5000)):
        urls.add(spark.range(n).select(F.concat(F.lit(f"https://h/{k}/"), "id").alias("key"), "id", F.lit(1).alias("mark")), k)
        ingest_batch(spark, payload(spark, ("s", feed((f"T{k}", f"https://s/{k}", "x")))), 100 + k, sink, urls, "2024-01-31")
        read.append(scan_rows(urls.entries(spark.createDataFrame([("https://h/0/7",)], "key string")), "key")[0])
    assert max(read) <= 100 * 2 and urls.summary()[0] > 7_000
