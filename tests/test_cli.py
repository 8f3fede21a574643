import json
import os
import tempfile

from newsloom.__main__ import main


def _feed(items):
    body = "".join(f"<item><title>{t}</title><link>{u}</link><description>{d}</description></item>"
                   for t, u, d in items)
    return f"<rss><channel>{body}</channel></rss>"


def test_two_runs_store_snapshots_and_add_nothing_twice(spark):
    root = tempfile.mkdtemp(prefix="newsloom-cli-")
    cat = os.path.join(root, "catalog")
    os.makedirs(cat)
    with open(os.path.join(cat, "sources.json"), "w") as f:
        json.dump({"version": "2.0", "global": {"default_weight": 0.5, "min_score_threshold": 0.6},
                   "domains": {"relational": {"weight": 1.0, "tags": ["sql"], "sources": [
                       {"name": "Blog", "url": "https://blog.org/feed", "weight": 1.0}]}}}, f)
    items = [(f"Post {i}", f"https://blog.org/p/{i}", "sql tuning") for i in range(4)]
    spark.createDataFrame([("Blog", "https://blog.org/feed", 0, _feed(items))],
                          "source string, feed_url string, source_ord int, body string") \
        .write.parquet(os.path.join(root, "payloads"))
    spark.createDataFrame([(f"https://blog.org/p/{i}", 200 if i else 404, "") for i in range(4)],
                          "url string, status int, error string").write.parquet(os.path.join(root, "links"))
    common = ["--as-of", "2024-01-31", "--catalog", cat, "--payloads", os.path.join(root, "payloads"),
              "--link-status", os.path.join(root, "links")]
    assert main(common + ["--out", os.path.join(root, "run1")]) == 1  # one brief link is a 404
    raw1 = spark.read.parquet(os.path.join(root, "run1", "raw"))
    assert sorted(r.id for r in raw1.collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(os.path.join(root, "run1", "scored")).count() == 4
    brief = spark.read.text(os.path.join(root, "run1", "briefs"), wholetext=True).first()["value"]
    assert "https://blog.org/p/0" in brief
    run2 = common + ["--raw", os.path.join(root, "run1", "raw"), "--scored", os.path.join(root, "run1", "scored"),
                     "--out", os.path.join(root, "run2")]
    main(run2)
    assert spark.read.parquet(os.path.join(root, "run2", "raw")).count() == 4
    assert spark.read.parquet(os.path.join(root, "run2", "scored")).count() == 4


def test_in_place_run_touches_only_new_dates(spark):
    import glob
    root = tempfile.mkdtemp(prefix="newsloom-cli-")
    cat = os.path.join(root, "catalog")
    os.makedirs(cat)
    with open(os.path.join(cat, "sources.json"), "w") as f:
        json.dump({"version": "2.0", "global": {"default_weight": 0.5, "min_score_threshold": 0.6},
                   "domains": {"d": {"weight": 1.0, "tags": [], "sources": [
                       {"name": "Blog", "url": "https://blog.org/feed", "weight": 1.0}]}}}, f)

    def payloads(name, n):
        items = [(f"Post {i}", f"https://blog.org/p/{i}", "text") for i in range(n)]
        path = os.path.join(root, name)
        spark.createDataFrame([("Blog", "https://blog.org/feed", 0, _feed(items))],
                              "source string, feed_url string, source_ord int, body string").write.parquet(path)
        return path

    p1, p2 = payloads("pay1", 3), payloads("pay2", 5)
    main(["--as-of", "2024-01-31", "--catalog", cat, "--payloads", p1, "--out", os.path.join(root, "run1")])
    raw, scored = os.path.join(root, "run1", "raw"), os.path.join(root, "run1", "scored")
    old_part = glob.glob(os.path.join(raw, "ingested_date=2024-01-31", "*.parquet"))
    stamps = {f: os.path.getmtime(f) for f in old_part}
    args = ["--catalog", cat, "--payloads", p2, "--raw", raw, "--scored", scored, "--in-place"]
    main(["--as-of", "2024-02-05"] + args + ["--out", os.path.join(root, "run2")])
    rows = spark.read.parquet(raw).collect()
    assert sorted((r.id, str(r.ingested_date)) for r in rows) == \
        [(1, "2024-01-31"), (2, "2024-01-31"), (3, "2024-01-31"), (4, "2024-02-05"), (5, "2024-02-05")]
    assert {f: os.path.getmtime(f) for f in old_part} == stamps  # untouched partition files kept
    assert sorted(r.raw_id for r in spark.read.parquet(scored).collect()) == [1, 2, 3, 4, 5]
    main(["--as-of", "2024-02-06"] + args + ["--out", os.path.join(root, "run3")])
    assert spark.read.parquet(raw).count() == 5 and spark.read.parquet(scored).count() == 5
