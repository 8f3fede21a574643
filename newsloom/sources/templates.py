"""Prompt templates, selected by run mode.

Fixed values: the template texts must equal the reference's so rendered prompts
(and the URLs an offline brief lists from them) are the same. A deployment can
instead read its own templates with :func:`read_templates`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Template texts.
ARTICLE_WEEKLY = 'You are writing a Weekly Database Engineering Brief.\n\nRules:\n- No speculation\n- Technical and objective\n- Focus on production systems\n- Markdown output\n\nArticles:\n{{articles}}\n\nWrite:\n\n# 🗞️ Weekly Database Engineering Brief – {{date}}\n\n## 🔥 Top Updates This Week\n(short summary)\n\n## 🧠 Trends Observed\n(bullets)\n\n## 🎯 Why This Matters\n(real DBA impact)\n\n## 🛠️ Action Items for DBAs\n(practical actions)\n\n## 📎 Sources\n(list URLs)'

ARTICLE_AI_RADAR = 'You are a senior AI Infrastructure Architect.\n\nAnalyze only articles related to:\n- Vector databases\n- Embeddings\n- RAG\n- LLM + SQL\n- AI in storage engines\n\nFocus on:\n- Scalability\n- Indexing implications\n- Cost impact\n- Production readiness\n- Long-term architectural impact\n\nRules:\n- No speculation\n- Technical and objective\n- Prioritize production concerns\n- Markdown output\n\nArticles:\n{{articles}}\n\nWrite:\n\n# 🤖 AI Radar – {{date}}\n\n## 🚨 High-Impact Signals\n(short summary)\n\n## 🧭 Architecture Implications\n(bullets)\n\n## 💸 Cost & Scalability Notes\n(bullets)\n\n## 🏭 Production Readiness\n(risks, blockers, maturity)\n\n## 🛠️ Recommended Actions\n(practical next steps)\n\n## 📎 Sources\n(list URLs)\n'

CLASSIFY_WEEKLY = 'Evaluate this article for a senior data platform engineer.\n\nScore from 0 to 1:\n- relevance\n- architectural_impact\n- production_impact\n- security_impact\n\nReturn JSON only.\n\nArticle:\n{{content}}'

CLASSIFY_AI_RADAR = 'You are a senior AI Infrastructure Architect.\n\nEvaluate this article only in the context of AI Radar themes:\n- Vector databases\n- Embeddings infrastructure\n- RAG systems\n- LLM + SQL integration\n- AI inside storage/database engines\n\nScore from 0 to 1:\n- relevance\n- architectural_impact\n- production_impact\n- security_impact\n- retrieval_complexity\n\nFocus on:\n- Scalability\n- Indexing implications\n- Cost impact\n- Production readiness\n- Long-term architectural impact\n\nReturn JSON only.\n\nArticle:\n{{content}}\n'


ARTICLE_TEMPLATES = {"weekly": ARTICLE_WEEKLY, "ai_radar": ARTICLE_AI_RADAR}
CLASSIFY_TEMPLATES = {"weekly": CLASSIFY_WEEKLY, "ai_radar": CLASSIFY_AI_RADAR}


def article_template(mode: str) -> str:
    return ARTICLE_TEMPLATES["ai_radar" if mode == "ai_radar" else "weekly"]


def classify_template(mode: str) -> str:
    return CLASSIFY_TEMPLATES["ai_radar" if mode == "ai_radar" else "weekly"]


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """``(template_name, template)`` from a folder of ``<name>.txt`` files (whole file per row)."""
    df = spark.read.text(path, wholetext=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1)
    return df.select(name.alias("template_name"), F.col("value").alias("template"))


def write_templates(spark: SparkSession, templates: dict[str, str], path: str) -> None:
    """Writes a few templates as ``<name>.txt`` files, replacing those that are there."""
    for name, text in templates.items():
        file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}.txt")
        out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
        out.write(bytearray(text.encode()))
        out.close()


def template_table(spark: SparkSession, templates: DataFrame | None, kind: str, modes) -> DataFrame:
    """``(mode, template)``: the template of ``kind`` ('article' or 'classify') of each mode, the stored
    ``<kind>_<mode>`` text if ``templates`` has it (of several the greatest), else the built-in one. Modes other than
    ai_radar use the weekly template."""
    names = {m: "ai_radar" if m == "ai_radar" else "weekly" for m in modes}
    built_in = {"article": ARTICLE_TEMPLATES, "classify": CLASSIFY_TEMPLATES}[kind]
    rows = spark.createDataFrame([(m, f"{kind}_{n}", built_in[n]) for m, n in names.items()],
                                 "mode string, template_name string, built_in string")
    if templates is None:
        return rows.select("mode", F.col("built_in").alias("template"))
    found = templates.groupBy("template_name").agg(F.max("template").alias("template"))
    return rows.join(found, "template_name", "left").select("mode", F.coalesce("template", "built_in").alias("template"))
