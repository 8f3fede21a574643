"""Brief text: prompt rendering, offline brief, JSON guard, URL repair and the Sources section."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bind
from .text import MARKDOWN_URL, canonical_url

# Fixed values that must equal the reference's behaviour.
OFFLINE_BRIEF_HEAD = ("## Weekly Database Engineering Brief\n\n"
                      "- Mock summary generated because `USE_OLLAMA` is disabled.\n\n"
                      "## \U0001F4CE Sources\n")
OFFLINE_NO_SOURCES = "- https://example.com"
OFFLINE_MAX_URLS = 7
SOURCES_HEADING = "## \U0001F4CE Sources\n"
# First heading line containing "sources" (any case): '##', whitespace (may span lines),
# then the rest of that line. Split as (text before)(heading line)(rest).
_WS = r"[\s\x1c-\x1f]"
SOURCES_SPLIT = r"(?siU)\A(.*?)((?:(?<=\n)|\A)##" + _WS + r"+[^\n]*sources[^\n]*(?=\n|\z))(.*)\z"
# The next '## ' heading after it ('###' does not count): (text before)(heading and the rest).
NEXT_HEADING_SPLIT = r"(?sU)\A(.*?)((?<=\n)##" + _WS + r".*)\z"


def article_line(title: Column, url: Column) -> Column:
    """``- {title} ({url})`` (Python formats None as 'None')."""
    return F.concat(F.lit("- "), F.coalesce(title, F.lit("None")), F.lit(" ("), F.coalesce(url, F.lit("None")),
                    F.lit(")"))


def render_prompt(template: Column, articles_md: Column, as_of: Column) -> Column:
    """Replace every ``{{articles}}`` then every ``{{date}}`` (run date, yyyy-MM-dd)."""
    with_articles = F.replace(template, F.lit("{{articles}}"), F.coalesce(articles_md, F.lit("")))
    return F.replace(with_articles, F.lit("{{date}}"), F.date_format(as_of, "yyyy-MM-dd"))


def offline_brief(prompt: Column) -> Column:
    """Markdown written when no model is available: the prompt's first 7 URLs (distinct) as Sources."""
    urls = F.array_distinct(F.slice(F.coalesce(F.regexp_extract_all(prompt, F.lit(MARKDOWN_URL), 0),
                                               F.array().cast("array<string>")), 1, OFFLINE_MAX_URLS))
    lines = F.array_join(F.transform(urls, lambda u: F.concat(F.lit("- "), u)), "\n")
    sources = F.when(F.size(urls) == 0, F.lit(OFFLINE_NO_SOURCES)).otherwise(lines)
    return F.concat(F.lit(OFFLINE_BRIEF_HEAD), sources, F.lit("\n"))


def is_json_text(text: Column) -> Column:
    """TRUE when the whole text is one JSON value (object, array, string, number, literal)."""
    t = F.trim(F.regexp_replace(text, r"^[ \t\n\r]+|[ \t\n\r]+$", ""))
    scalar = t.rlike(r'^(?:-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity|"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")$')
    # As the first of two array elements: text after the value would close the array early or add elements.
    whole = F.from_json(F.concat(F.lit("["), t, F.lit(",1]")), "ARRAY<STRING>", {"allowSingleQuotes": "false"})
    container = (t.rlike(r"(?s)^[\[{].*[\]}]$")
                 & (F.size(whole) == 2) & (F.get(whole, F.lit(1)) == "1"))
    return F.coalesce(scalar | container, F.lit(False))


def reject_json_output(markdown: Column) -> Column:
    """NULL (keep the previous brief) when the generated text is valid JSON, else the text."""
    return F.when(is_json_text(markdown), F.lit(None).cast("string")).otherwise(markdown)


def normalize_url_prefixes(md: Column, source_urls: Column) -> Column:
    """Rewrite each URL token's first occurrence: known canonical form, else the single source URL
    it is a prefix of, else its canonical form. Later repeats are left as written."""
    def go(text: Column) -> Column:
        sources = F.transform(source_urls, lambda u: canonical_url(u))
        tokens = F.regexp_extract_all(text, F.lit(MARKDOWN_URL), 0)
        gaps = F.split(text, MARKDOWN_URL, -1)

        def repl(t: Column) -> Column:
            ct = canonical_url(t)
            longer = F.filter(sources, lambda s: s.startswith(t))
            return (F.when(F.array_contains(sources, ct), ct)
                    .when(F.size(longer) == 1, longer[0])
                    .otherwise(ct))

        new_tokens = F.transform(tokens, lambda t, i: F.when(F.array_position(tokens, t) == i + 1, repl(t))
                                 .otherwise(t))
        pieces = F.zip_with(gaps, F.concat(new_tokens, F.array(F.lit(""))), lambda g, t: F.concat(g, t))
        return F.array_join(pieces, "")

    empty = md.isNull() | (md == "") | source_urls.isNull() | (F.size(source_urls) == 0)
    return F.when(empty, md).otherwise(bind(md, go))


def replace_sources_section(md: Column, source_urls: Column) -> Column:
    """Put the canonical, ordered-distinct source URLs under ``## 📎 Sources``.

    The first heading line containing 'sources' (any case) is replaced up to the
    next ``## `` heading (``###`` does not end it); without one the section is
    appended after stripping trailing whitespace.
    """
    def go(text: Column) -> Column:
        urls = F.array_distinct(F.filter(F.transform(source_urls, lambda u: canonical_url(u)),
                                         lambda u: u.isNotNull() & (u != "")))
        block = F.array_join(F.transform(urls, lambda u: F.concat(F.lit("- "), u)), "\n")
        section = F.concat(F.lit(SOURCES_HEADING), block, F.lit("\n"))
        found = text.rlike(SOURCES_SPLIT)
        before = F.regexp_extract(text, SOURCES_SPLIT, 1)
        rest = F.regexp_extract(text, SOURCES_SPLIT, 3)
        tail = F.when(rest.rlike(NEXT_HEADING_SPLIT), F.regexp_extract(rest, NEXT_HEADING_SPLIT, 2)).otherwise(F.lit(""))
        replaced = F.concat(before, section, tail)
        appended = F.concat(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+\z", ""), F.lit("\n\n"), section)
        return F.when(F.size(urls) == 0, text).when(found, replaced).otherwise(appended)

    none = source_urls.isNull() | (F.size(source_urls) == 0) | md.isNull()
    return F.when(none, md).otherwise(bind(md, go))


def classify_prompt(template: str | Column, content: Column) -> Column:
    """Classification prompt: every ``{{content}}`` replaced by the normalised article text."""
    from .text import normalize_text
    return F.replace(template if isinstance(template, Column) else F.lit(template), F.lit("{{content}}"), normalize_text(content))
