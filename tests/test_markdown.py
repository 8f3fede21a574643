from pyspark.sql import functions as F
from conftest import one

from newsloom.functions.markdown import (is_json_text, normalize_url_prefixes, offline_brief,
                                         replace_sources_section)


def _apply(spark, fn, md, urls):
    df = spark.createDataFrame([(md, urls)], "md string, u array<string>")
    return df.select(fn(F.col("md"), F.col("u")).alias("o")).first()["o"]


def test_prefix_repair_first_occurrence_only(spark):
    urls = ["https://a.org/post/123?x=1", "https://b.org/q"]
    md = "see https://a.org/post/1 and https://a.org/post/1 and https://b.org/q,"
    assert _apply(spark, normalize_url_prefixes, md, urls) == \
        "see https://a.org/post/123?x=1 and https://a.org/post/1 and https://b.org/q,"


def test_prefix_repair_ambiguous_and_canonical(spark):
    urls = ["https://a.org/p1", "https://a.org/p2", "https://dba.stackexchange.com/questions/9/slug"]
    md = "x https://a.org/p y https://dba.stackexchange.com/questions/9/other z"
    assert _apply(spark, normalize_url_prefixes, md, urls) == \
        "x https://a.org/p y https://dba.stackexchange.com/questions/9/ z"


def test_sources_section_replace_and_append(spark):
    urls = ["https://a.org/1", "https://a.org/1", "https://b.org/2"]
    md = "# T\n## \U0001F4CE SOURCES\n- old\n### keep out\n## Next\nbody"
    assert _apply(spark, replace_sources_section, md, urls) == \
        "# T\n## \U0001F4CE Sources\n- https://a.org/1\n- https://b.org/2\n## Next\nbody"
    assert _apply(spark, replace_sources_section, "# T\nbody \n\n", urls) == \
        "# T\nbody\n\n## \U0001F4CE Sources\n- https://a.org/1\n- https://b.org/2\n"
    assert _apply(spark, replace_sources_section, "# T", []) == "# T"


def test_offline_brief_and_json_guard(spark):
    prompt = "\n".join(f"- t{i} (https://x.org/{i % 8})" for i in range(10))
    df = spark.createDataFrame([(prompt,), ("no urls",)], "p string")
    out = [r["o"] for r in df.select(offline_brief(F.col("p")).alias("o")).collect()]
    assert out[0].endswith("## \U0001F4CE Sources\n" + "\n".join(f"- https://x.org/{i}" for i in range(7)) + "\n")
    assert out[1].endswith("- https://example.com\n")
    texts = ['{"a": 1}', "[1, 2]", "5", '"s"', "null", "## Brief\n- x", '{"a": 1} tail', ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["o"] for r in df.select("i", is_json_text(F.col("t")).alias("o")).orderBy("i").collect()]
    assert got == [True, True, True, True, True, False, False, False]


def test_sources_section_after_astral_emoji_and_multiple_headings(spark):
    urls = ["https://a.org/1"]
    md = ("# \U0001F5DE️ Weekly \U0001F4CE\U0001F4CE brief\n## \U0001F4CE Sources\n(list URLs)\n"
          "## Other sources\n- keep\n")
    assert _apply(spark, replace_sources_section, md, urls) == \
        "# \U0001F5DE️ Weekly \U0001F4CE\U0001F4CE brief\n## \U0001F4CE Sources\n- https://a.org/1\n## Other sources\n- keep\n"
    # '##' followed by a newline still opens a heading (whitespace may span lines), '##x' does not
    md2 = "intro\n##sources no\n##\nmy sources\nbody\n## Next\nz"
    assert _apply(spark, replace_sources_section, md2, urls) == \
        "intro\n##sources no\n## \U0001F4CE Sources\n- https://a.org/1\n## Next\nz"


def test_prefix_repair_tokens_at_both_ends(spark):
    urls = ["https://a.org/full/path"]
    md = "https://a.org/full mid https://a.org/full"
    assert _apply(spark, normalize_url_prefixes, md, urls) == "https://a.org/full/path mid https://a.org/full"


def test_only_whole_json_values_count_as_json(spark):
    from newsloom.functions.markdown import is_json_text
    yes = ["{}", '{"a": [1]}', "[1, 2]", ' {"a": "}"} ', "null", "[]"]
    no = ["{}}", '{"a": 1}]}', "{} {}", "{}, {}", "[1] x", "[1],[2]", "# Brief", ""]
    assert one(spark, is_json_text, yes) == [True] * len(yes)
    assert one(spark, is_json_text, no) == [False] * len(no)


def test_repaired_markdown_holds_only_known_urls_and_is_stable(spark):
    from pyspark.sql import functions as F
    from newsloom.functions.markdown import normalize_url_prefixes, replace_sources_section
    cases = [("see https://a.org/x and https://b.org/q?z=1", ["https://a.org/x/y", "https://b.org/q?z=1"],
              "see https://a.org/x/y and https://b.org/q?z=1"),
             ("nothing here", ["https://a.org/x/y"], "nothing here"), ("see https://c.org/", [], "see https://c.org/")]
    df = spark.createDataFrame(cases, "md string, u array<string>, want string")
    for r in df.select("md", "u", "want", normalize_url_prefixes(F.col("md"), F.col("u")).alias("p")).withColumn(
            "again", normalize_url_prefixes(F.col("p"), F.col("u"))).withColumn(
            "s", replace_sources_section(F.col("md"), F.col("u"))).collect():
        assert r["p"] == r["want"] and r["again"] == r["p"]
        assert all(u in r["s"] for u in r["u"])
