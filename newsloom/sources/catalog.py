"""Source catalog: read the v2 / legacy JSON documents and flatten them in document order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.signals import clamp01_text, normalize_tags, py_float
from ..functions.text import normalize_text

# Numbers are read as text and parsed with Python float() rules.
CATALOG_SCHEMA = (
    "version STRING, global STRUCT<default_weight: STRING, min_score_threshold: STRING>, "
    "domains MAP<STRING, STRUCT<weight: STRING, description: STRING, tags: ARRAY<STRING>, "
    "sources: ARRAY<STRUCT<name: STRING, url: STRING, weight: STRING, priority: STRING>>>>"
)
LEGACY_SCHEMA = "sources MAP<STRING, STRING>"
LEGACY_ENTRY = "ARRAY<STRUCT<name: STRING, url: STRING>>"

# Fixed values that must equal the reference's behaviour.
DEFAULT_WEIGHT = 0.5
DEFAULT_MIN_SCORE = 0.6
RADAR_MODE = "ai_radar"
RADAR_DOMAINS = ("ai_data",)
DEFAULT_MODE = "weekly"

FLAT_COLUMNS = ["doc_ord", "domain_pos", "source_pos", "domain", "domain_weight", "tags",
                "description", "name", "url", "weight", "priority", "default_weight", "min_score_threshold", "kind"]


def parse_catalog(docs: DataFrame, text_col: str = "value", doc_ord_col: str = "doc_ord") -> DataFrame:
    """Rows of v2 catalog JSON text -> one row per source entry.

    Order key ``(doc_ord, domain_pos, source_pos)`` is document order. Weights are
    clamped like the reference (default = the document's global default weight). A
    document or domain without sources gives one row of kind ``global``: it carries the
    catalog-level values and is neither selected nor looked up. Broken JSON fails the job.
    """
    parsed = docs.select(F.col(doc_ord_col).alias("doc_ord"),
                         F.from_json(F.col(text_col), CATALOG_SCHEMA, {"mode": "FAILFAST"}).alias("c"))
    return flatten_catalog(parsed)


def flatten_catalog(parsed: DataFrame) -> DataFrame:
    raw_default = F.coalesce(py_float(F.col("c.global.default_weight")), F.lit(DEFAULT_WEIGHT))
    min_score = F.coalesce(py_float(F.col("c.global.min_score_threshold")), F.lit(DEFAULT_MIN_SCORE))
    domains = parsed.select(
        "doc_ord", raw_default.alias("raw_default"), min_score.alias("min_score_threshold"),
        F.posexplode_outer(F.map_entries("c.domains")).alias("domain_pos", "d"))
    entries = domains.select(
        "doc_ord", "domain_pos", "raw_default", "min_score_threshold",
        F.col("d.key").alias("domain"), F.col("d.value").alias("dv"),
        F.posexplode_outer(F.col("d.value.sources")).alias("source_pos", "s"))
    return entries.select(
        "doc_ord", "domain_pos", "source_pos", "domain",
        clamp01_text(F.col("dv.weight"), F.col("raw_default")).alias("domain_weight"),
        F.coalesce(F.col("dv.tags"), F.array().cast("array<string>")).alias("tags"),
        F.col("dv.description").alias("description"),
        F.col("s.name").alias("name"), F.col("s.url").alias("url"),
        clamp01_text(F.col("s.weight"), F.col("raw_default")).alias("weight"),
        F.col("s.priority").alias("priority"),
        clamp01_text(F.lit(None).cast("string"), F.col("raw_default")).alias("default_weight"),
        "min_score_threshold", F.when(F.col("source_pos").isNull(), "global").otherwise("v2").alias("kind"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Read catalog files (one JSON document per file, v2 or legacy) from ``path``; file order = document order."""
    return parse_documents(spark.read.text(path, wholetext=True)
                           .select(F.col("value"), F.input_file_name().alias("doc_ord")))


def parse_documents(docs: DataFrame) -> DataFrame:
    """Catalog documents ``(doc_ord, value)`` of either kind, told apart one by one: a document with an object
    ``domains`` is a v2 catalog, any other JSON object a legacy one. What is no JSON object fails the job."""
    domains = F.get_json_object("value", "$.domains")
    # An escaped or spaced key reads the same; the first character tells an object.
    is_object = F.coalesce(F.ltrim(domains).startswith("{"), F.lit(False))
    readable = F.get_json_object("value", "$").isNotNull() & F.ltrim(F.col("value"), F.lit(" \t\r\n")).startswith("{")
    legacy = readable & ~is_object
    return parse_catalog(docs.where(~legacy)).unionByName(parse_legacy_catalog(docs.where(legacy)))


def parse_legacy_catalog(docs: DataFrame, text_col: str = "value", doc_ord_col: str = "doc_ord") -> DataFrame:
    """Legacy ``{"sources": {category: [{name, url}]}}`` -> the same flat shape as v2.

    Only list-valued categories contribute; domain fields are NULL.
    """
    parsed = docs.select(F.col(doc_ord_col).alias("doc_ord"),
                         F.from_json(F.col(text_col), LEGACY_SCHEMA).alias("c"))
    cats = parsed.select("doc_ord", F.posexplode(F.map_entries("c.sources")).alias("domain_pos", "e"))
    entries = cats.select("doc_ord", "domain_pos", F.col("e.key").alias("domain"),
                          F.posexplode(F.from_json(F.col("e.value"), LEGACY_ENTRY)).alias("source_pos", "s"))
    return entries.select(
        "doc_ord", "domain_pos", "source_pos", "domain",
        F.lit(None).cast("double").alias("domain_weight"), F.array().cast("array<string>").alias("tags"),
        F.lit(None).cast("string").alias("description"),
        F.col("s.name").alias("name"), F.col("s.url").alias("url"),
        F.lit(None).cast("double").alias("weight"), F.lit(None).cast("string").alias("priority"),
        F.lit(DEFAULT_WEIGHT).alias("default_weight"), F.lit(DEFAULT_MIN_SCORE).alias("min_score_threshold"),
        F.lit("legacy").alias("kind"))


def normalize_mode(mode) -> Column:
    m = F.lit(mode) if isinstance(mode, str) else mode
    return F.coalesce(F.lower(F.regexp_replace(m, r"(?U)^\s+|\s+$", "")), F.lit(DEFAULT_MODE))


def select_sources(catalog: DataFrame, mode: str, radar_domains=RADAR_DOMAINS) -> DataFrame:
    """Entries chosen for a run mode, with flags.

    ``selected``: the entry's domain is processed in this mode (ai_radar keeps
    only ``radar_domains``; legacy entries are always processed). ``ingestable``:
    it has both a name and a URL. ``filter_active``: at least one v2 entry is
    selected; when false the run uses no source filter at all (not an empty
    one). Legacy entries never contribute names to the filter.
    """
    m = normalize_mode(mode)
    catalog = catalog.where(F.col("kind") != "global")
    picked = (F.when(F.col("kind") == "legacy", F.lit(True))
              .when(m == RADAR_MODE, F.col("domain").isin(*radar_domains)).otherwise(F.lit(True)))
    flagged = catalog.select("*", m.alias("mode"), picked.alias("selected"),
                             (F.col("name").isNotNull() & F.col("url").isNotNull()).alias("ingestable"))
    any_selected = flagged.where(F.col("selected") & (F.col("kind") == "v2")).select(F.count(F.lit(1)) > 0).scalar()
    return flagged.withColumn("filter_active", any_selected)


def allowed_source_names(selection: DataFrame) -> DataFrame:
    """Distinct names the run filters on (a missing name counts as '')."""
    return (selection.where(F.col("selected") & (F.col("kind") == "v2"))
            .select(F.coalesce("name", F.lit("")).alias("source")).distinct())


def source_lookup(catalog: DataFrame) -> DataFrame:
    """lower(name) -> (domain, domain_weight, tags, weight); the last entry in document order wins.

    Tags are normalised once here (lower(normalize(str(tag)))).
    """
    key = F.lower(F.coalesce(F.col("name"), F.lit("unknown")))
    order = F.struct("doc_ord", "domain_pos", "source_pos")
    catalog = catalog.where(F.col("kind") == "v2")  # weights and tags exist only in v2 catalogs
    picked = F.struct(F.col("domain"), F.col("domain_weight"), normalize_tags(F.col("tags")).alias("tags"),
                      F.col("weight"))
    return (catalog.groupBy(key.alias("lookup_key"))
            .agg(F.max_by(picked, order).alias("v"))
            .select("lookup_key", F.col("v.domain").alias("domain"), F.col("v.domain_weight").alias("domain_weight"),
                    F.col("v.tags").alias("tags"), F.col("v.weight").alias("source_weight")))


def article_lookup_key(source) -> Column:
    return F.lower(normalize_text(F.col(source) if isinstance(source, str) else source))
