"""Model signals: clamp to [0, 1], parse the JSON answer, and the two scoring formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bind, memo_column
from .numeric import py_round
from .text import normalize_text

# Fixed values that must equal the reference's behaviour.
SIGNALS = ("relevance", "architectural_impact", "production_impact",
           "security_impact", "retrieval_complexity")
SIGNAL_DEFAULT = 0.5
DB_ENGINE_DEFAULT = "general"
TOPIC_DEFAULT = "tooling"
WEEKLY_WEIGHTS = (("domain_weight", 0.25), ("source_weight", 0.15), ("keyword_score", 0.15),
                  ("relevance", 0.20), ("architectural_impact", 0.15), ("production_impact", 0.10))
AI_RADAR_WEIGHTS = (("domain_weight", 0.20), ("source_weight", 0.10), ("keyword_score", 0.10),
                    ("relevance", 0.20), ("architectural_impact", 0.15), ("production_impact", 0.10),
                    ("security_impact", 0.10), ("retrieval_complexity", 0.05))
TOP_DOMAIN_WEIGHT = 1.0
TOP_DOMAIN_BOOST = 1.15
OFFLINE_SIGNALS = {"db_engine": "PostgreSQL", "topic": "Release", "relevance": 0.7,
                   "architectural_impact": 0.7, "production_impact": 0.7,
                   "security_impact": 0.6, "retrieval_complexity": 0.5}

# Text accepted by Python's float(): decimal or exponent form with single
# underscores between digits, or nan/inf/infinity; surrounding whitespace allowed.
_DIGITS = r"\d(?:_?\d)*"
PY_FLOAT_TEXT = (r"(?U)^\s*[+-]?(?:(?:" + _DIGITS + r"(?:\." + "(?:" + _DIGITS + r")?)?|\." + _DIGITS + r")"
                 r"(?:[eE][+-]?" + _DIGITS + r")?|(?i:nan|inf|infinity))\s*$")


def py_float(text: Column) -> Column:
    return bind(text, _py_float)


def _py_float(text: Column) -> Column:
    """Python ``float()`` of the text form of a JSON value; NULL when Python would raise.

    JSON ``true``/``false`` arrive as the text 'true'/'false' and map to 1.0/0.0
    (the text form cannot tell them from the strings "true"/"false").
    """
    t = F.regexp_replace(text, r'^"(.*)"$', "$1")  # bare NaN/Infinity arrive quoted
    s = F.lower(F.trim(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]", " ")))
    unsigned = F.regexp_replace(s, r"^[+-]", "")
    neg = s.startswith("-")
    special = (F.when(unsigned == "nan", F.lit(float("nan")))
               .when(unsigned.isin("inf", "infinity"),
                     F.when(neg, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))))
    numeric = F.when(t.rlike(PY_FLOAT_TEXT),
                     F.coalesce(special, F.regexp_replace(s, "_", "").try_cast("double")))
    return (F.when(text.isNull(), F.lit(None).cast("double"))
            .when(text == "true", F.lit(1.0))
            .when(text == "false", F.lit(0.0))
            .otherwise(numeric))


def clamp01(value: Column, default=SIGNAL_DEFAULT) -> Column:
    """float(value) or default; values in (1, 5] are divided by 5; then clamped to [0, 1]; NaN -> 0.

    ``default`` (a number or a DOUBLE column) goes through the same rescale and clamp.
    """
    dflt = default if isinstance(default, Column) else F.lit(float(default))
    return bind(F.coalesce(value.cast("double"), dflt), _clamp)


def _clamp(v: Column) -> Column:
    v = F.when((v > 1.0) & (v <= 5.0) & ~F.isnan(v), v / F.lit(5.0)).otherwise(v)
    return (F.when(F.isnan(v), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(v, F.lit(1.0)))))


def clamp01_text(text: Column, default=SIGNAL_DEFAULT) -> Column:
    return clamp01(py_float(text), default)


_RESPONSE_SCHEMA = ", ".join(f"`{k}` STRING" for k in SIGNALS + ("db_engine", "topic")) + ", `_corrupt_record` STRING"
_JSON_OBJECT = r"(?s)^[ \t\n\r]*\{.*\}[ \t\n\r]*\z"


def _has_key(response: Column, keys: Column, name: str) -> Column:
    # json_object_keys gives NULL for objects holding NaN; fall back to the text.
    return F.coalesce(F.array_contains(keys, name), response.rlike(f'"{name}"[ \\t\\n\\r]*:'))


def parse_signals(response: Column) -> Column:
    """JSON answer -> struct(ok, five clamped signals, db_engine, topic).

    ``ok`` is false for text that is not one JSON object (the article stays
    unscored). Absent signals and JSON nulls become 0.5; absent ``db_engine``/``topic``
    become 'general'/'tooling' while an explicit JSON null stays NULL.
    """
    parsed = F.from_json(response, _RESPONSE_SCHEMA, {"allowSingleQuotes": "false",
                                                     "allowNonNumericNumbers": "true",
                                                     "columnNameOfCorruptRecord": "_corrupt_record"})
    # As the first of two array elements, text after the object ('{..}}', '{..} {..}', '{..}, {..}') no longer fits.
    whole = F.from_json(F.concat(F.lit("["), response, F.lit(",1]")), "ARRAY<STRING>", {"allowSingleQuotes": "false"})
    once = F.struct(parsed.alias("parsed"), F.json_object_keys(response).alias("keys"),
                    ((F.size(whole) == 2) & (F.get(whole, F.lit(1)) == "1")).alias("alone"), response.alias("text"))
    return bind(once, _signals_of)


def _signals_of(r: Column) -> Column:
    parsed, keys, response = r["parsed"], r["keys"], r["text"]
    ok = F.coalesce(response.rlike(_JSON_OBJECT) & parsed.isNotNull() & parsed["_corrupt_record"].isNull() & r["alone"],
                    F.lit(False))
    fields = [clamp01_text(parsed[k]).alias(k) for k in SIGNALS]
    engine = F.when(_has_key(response, keys, "db_engine"), parsed["db_engine"]).otherwise(F.lit(DB_ENGINE_DEFAULT))
    topic = F.when(_has_key(response, keys, "topic"), parsed["topic"]).otherwise(F.lit(TOPIC_DEFAULT))
    return F.when(ok, F.struct(F.lit(True).alias("ok"), *fields, engine.alias("db_engine"), topic.alias("topic"))) \
            .otherwise(F.struct(F.lit(False).alias("ok"), *[F.lit(None).cast("double").alias(k) for k in SIGNALS],
                                F.lit(None).cast("string").alias("db_engine"),
                                F.lit(None).cast("string").alias("topic")))


def offline_signals() -> Column:
    """The constant answer used when no model is available."""
    return F.struct(F.lit(True).alias("ok"),
                    *[F.lit(float(OFFLINE_SIGNALS[k])).alias(k) for k in SIGNALS],
                    F.lit(OFFLINE_SIGNALS["db_engine"]).alias("db_engine"),
                    F.lit(OFFLINE_SIGNALS["topic"]).alias("topic"))


def keyword_ratio(content: Column, tags: Column) -> Column:
    """Share of tags found (substring, case-insensitive, whitespace-normalised) in content, unrounded.

    ``tags`` should already be normalised with :func:`normalize_tags`. No tags -> 0.0.
    Normalising only collapses whitespace, so a tag without a space matches the
    normalised text exactly when it matches the lower-cased raw text; the
    whitespace regex over the whole text runs only for multi-word tags.
    """
    # Bound values: the normalised text is built once per row, and only where a tag has several words.
    several = F.exists(tags, lambda t: t.contains(" "))
    texts = F.struct(F.lower(F.coalesce(content, F.lit(""))).alias("low"),
                     F.when(several, F.lower(normalize_text(content))).alias("norm"))
    n = F.size(tags)
    h = bind(texts, lambda x: F.size(F.filter(tags, lambda t: F.when(t.contains(" "), x["norm"].contains(t))
                                              .otherwise(x["low"].contains(t)))))
    return F.when(tags.isNull() | (n <= 0), F.lit(0.0)).otherwise(h.cast("double") / n.cast("double"))


def normalize_tags(tags: Column) -> Column:
    """lower(normalize(str(tag))) per tag; a JSON null tag reads as 'none' like Python's str(None)."""
    return F.transform(tags, lambda t: F.lower(normalize_text(F.coalesce(t, F.lit("None")))))


def impact_raw(mode: str = "weekly", **cols: Column) -> Column:
    """Weighted sum in the reference's term order, x1.15 for a top domain (before cap and rounding).

    ``cols`` maps every name in the mode's weight table to a DOUBLE column.
    """
    weights = AI_RADAR_WEIGHTS if mode == "ai_radar" else WEEKLY_WEIGHTS
    total = None
    for name, w in weights:
        term = cols[name] * F.lit(w)
        total = term if total is None else total + term
    return F.when(cols["domain_weight"] == F.lit(TOP_DOMAIN_WEIGHT), total * F.lit(TOP_DOMAIN_BOOST)).otherwise(total)


def finish_score(raw: Column) -> Column:
    """``round(min(raw, 1.0), 3)`` with Python rounding; apply to a materialised column."""
    return py_round(F.least(raw, F.lit(1.0)), 3)


def with_keyword_score(df: DataFrame, content: str = "content", tags: str = "tags") -> DataFrame:
    """Add ``keyword_score`` (DOUBLE, 3 decimals)."""
    expr = memo_column(("keyword_score", content, tags),
                       lambda: py_round(keyword_ratio(F.col(content), F.col(tags)), 3))
    return df.withColumn("keyword_score", expr)


def with_impact_score(df: DataFrame, mode: str = "weekly", signals: str = "sig") -> DataFrame:
    """Add ``impact_score`` (FLOAT, like a REAL column) from weights, ``keyword_score`` and signals."""
    return df.withColumn("impact_score", impact_score(mode, signals))


def impact_score(mode: str, signals: str = "sig") -> Column:
    return memo_column(("impact_score", mode, signals), lambda: _impact_score_expr(mode, signals))


def _impact_score_expr(mode: str, signals: str) -> Column:
    cols = {k: F.col(f"{signals}.{k}") for k in SIGNALS}
    cols.update(domain_weight=F.col("domain_weight"), source_weight=F.col("source_weight"),
                keyword_score=F.col("keyword_score"))
    return finish_score(impact_raw(mode, **cols)).cast("float")


def with_scores(df: DataFrame, mode: str = "weekly", content: str = "content", tags: str = "tags",
                signals: str = "sig") -> DataFrame:
    """Add ``keyword_score`` (DOUBLE) and ``impact_score`` (FLOAT)."""
    return with_impact_score(with_keyword_score(df, content, tags), mode, signals)
