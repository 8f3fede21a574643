from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one
from newsloom.functions.numeric import py_round
from newsloom.functions.signals import clamp01_text, impact_raw, finish_score, parse_signals


# Worked by hand: unreadable text is the default, 1 to 5 is a five-point answer, the rest is cut to 0..1.
CLAMPED = {"": 0.5, "0.7": 0.7, " 0.7 ": 0.7, "0.5d": 0.5, "1_0": 1.0, "nan": 0.0, "inf": 1.0, "-inf": 0.0, "-1": 0.0, "0": 0.0,
           "1": 1.0, "1.0001": 0.20002, "5": 1.0, "5.01": 1.0, "2": 0.4, "3": 0.6, "abc": 0.5, "1e2": 1.0, "1e400": 1.0}


def test_clamp_fixture(spark):
    raw = [None, *CLAMPED]
    got = one(spark, clamp01_text, raw)
    want = [0.5, *CLAMPED.values()]
    assert [round(g, 12) for g in got] == want


def test_clamp_json_true(spark):
    r = spark.createDataFrame([('{"relevance": true}',)], "r string")
    s = r.select(parse_signals(F.col("r")).alias("s")).first()["s"]
    assert s["relevance"] == 1.0


def test_parse_signals_texts(spark):
    texts = ['```json\n{"relevance": 0.9}\n```', '{"relevance": 0.9} trailing', "{'relevance': 0.9}", "[1]", "5", "",
             '{"relevance": 0.9, "db_engine": null}', '{"relevance": "3", "topic": "Perf"}', '{"a": NaN}',
             '{"a": 1} {"b": 2}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, r string")
    out = [r["s"] for r in df.select("i", parse_signals(F.col("r")).alias("s")).orderBy("i").collect()]
    assert [o["ok"] for o in out] == [False, False, False, False, False, False, True, True, True, False]
    assert out[6]["db_engine"] is None and out[6]["topic"] == "tooling" and out[6]["relevance"] == 0.9
    assert out[7]["relevance"] == 0.6 and out[7]["db_engine"] == "general" and out[7]["topic"] == "Perf"
    assert out[8]["relevance"] == 0.5


@settings(max_examples=1, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=2, allow_nan=False), min_size=200, max_size=200))
def test_py_round_matches_python(spark, xs):
    xs = xs + [0.0625, 0.6125, 0.0005, 0.0015, 0.1235, 2.675, 1 / 3, 2 / 3, 0.5, 1.0]
    got = one(spark, lambda c: py_round(c, 3), xs, "v double")
    assert got == [round(x, 3) for x in xs]


SCORE_TABLE = [  # mode, dw, sw, kw, rel, arch, prod, sec, retr, expected (hand-computed)
    ("weekly", 0.8, 0.9, 0.2, 0.7, 0.7, 0.7, 0.5, 0.5, 0.68),
    ("weekly", 1.0, 1.0, 0.0, 0.7, 0.7, 0.7, 0.5, 0.5, 0.822),
    ("weekly", 0.5, 0.5, 0.0, 0.7, 0.7, 0.7, 0.5, 0.5, 0.515),
    ("ai_radar", 1.0, 1.0, 0.143, 0.7, 0.7, 0.7, 0.6, 0.5, 0.821),
    ("ai_radar", 0.8, 0.9, 0.2, 0.7, 0.7, 0.7, 0.6, 0.5, 0.67),
    ("weekly", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.5, 0.5, 1.0),
]


def test_score_table(spark):
    names = ["domain_weight", "source_weight", "keyword_score", "relevance", "architectural_impact",
             "production_impact", "security_impact", "retrieval_complexity"]
    for mode, *vals, expected in SCORE_TABLE:
        df = spark.createDataFrame([tuple(vals)], ", ".join(f"{n} double" for n in names))
        raw = df.select(impact_raw(mode, **{n: F.col(n) for n in names}).alias("r"))
        got = raw.select(finish_score(F.col("r")).alias("s")).first()["s"]
        assert got == expected, (mode, vals, got)


def test_keyword_ratio_single_and_multi_word_tags(spark):
    from newsloom.functions.signals import keyword_ratio, normalize_tags
    df = spark.createDataFrame([("Query  PLANNER\tand\u00a0Index\ttuning", ["planner", "index tuning", " Query   planner ", "", "zz"]),
                                (None, ["", "a"]), ("text", [])], "c string, t array<string>")
    got = [r["k"] for r in df.select(keyword_ratio(F.col("c"), normalize_tags(F.col("t"))).alias("k")).collect()]
    assert got == [4 / 5, 1 / 2, 0.0]


def test_text_after_the_object_is_not_an_answer(spark):
    bad = ['{"relevance": 1}}', '{"relevance": 1}]}', '{"relevance": 1} {"topic": "x"}', '{"relevance": 1}, {"topic": "x"}',
           '{"relevance": 1},"x":{"a":1}', '{"relevance": 1}],[{"a":1}', '{}}', "{", '[{"relevance": 1}]']
    good = ['{"relevance": 1}', ' {"relevance": 1}\n', "{}", '{"a": {"b": [1, {"c": 2}]}}']
    assert [s["ok"] for s in one(spark, parse_signals, bad)] == [False] * len(bad)
    assert [s["ok"] for s in one(spark, parse_signals, good)] == [True] * len(good)
