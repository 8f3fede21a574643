"""Text and URL functions (normalise, canonical URLs, URL extraction, link repair, URL join).

Patterns are Java regular expressions chosen to match Python ``re`` on str:
``(?U)`` makes ``\\s``/``\\d`` Unicode-aware, ``\\x1c-\\x1f`` are added because
Python counts them as whitespace, and ``(?d)`` restricts line terminators to
``\\n`` as in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bind

# Fixed values that must equal the reference's behaviour.
WS_RUN = r"(?U)[\s\x1c-\x1f]+"
STACKEXCHANGE_PREFIX = r"(?iU)^(https?://[^/]*stackexchange\.com/questions/\d+)"
STACKEXCHANGE_FULL = STACKEXCHANGE_PREFIX + r"[^\n]*\n?\z"
HREF_URL = r"""(?i)href=["'](https?://[^"']+)["']"""
RAW_URL = r"""(?U)https?://[^\s\x1c-\x1f<>")']+"""
MARKDOWN_URL = r"(?U)https?://[^\s\x1c-\x1f)]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c) -> Column:
    """NULL/empty -> ''; every whitespace run -> one space; trimmed."""
    c = _col(c)
    return F.when(c.isNull(), F.lit("")).otherwise(F.trim(F.regexp_replace(c, WS_RUN, " ")))


def canonical_url(c) -> Column:
    """``https://x.stackexchange.com/questions/<n>/slug?...`` -> ``.../questions/<n>/``; others unchanged."""
    return bind(_col(c), lambda u: F.when(u.rlike(STACKEXCHANGE_FULL), F.concat(
        F.regexp_extract(u, STACKEXCHANGE_PREFIX, 1), F.lit("/"))).otherwise(u))


def extract_urls(c) -> Column:
    """href URLs first (case-insensitive attribute), then bare URLs; first occurrence kept, order kept."""
    c = _col(c)
    href = F.regexp_extract_all(c, F.lit(HREF_URL), 1)
    raw = F.regexp_extract_all(c, F.lit(RAW_URL), 0)
    return F.coalesce(F.array_distinct(F.concat(href, raw)), F.array().cast("array<string>"))


def markdown_urls(c) -> Column:
    """URLs in Markdown (stop at whitespace or ')'), ordered distinct."""
    c = _col(c)
    return F.coalesce(F.array_distinct(F.regexp_extract_all(c, F.lit(MARKDOWN_URL), 0)),
                      F.array().cast("array<string>"))


def repair_link(link, content) -> Column:
    """Canonical link, or the single candidate URL in ``content`` that strictly extends it.

    A NULL link with candidate URLs gives NULL (the item is dropped later).
    """
    both = F.struct(canonical_url(_col(link)).alias("l"),
                    F.transform(extract_urls(_col(content)), lambda u: canonical_url(u)).alias("c"))

    def pick(v: Column) -> Column:
        link_c, cands = v["l"], v["c"]
        longer = F.filter(cands, lambda u: u.startswith(link_c) & (F.length(u) > F.length(link_c)))
        return (F.when(F.size(cands) == 0, link_c)
                .when(link_c.isNull(), F.lit(None).cast("string"))
                .when(F.array_contains(cands, link_c), link_c)
                .when(F.size(longer) == 1, longer[0])
                .otherwise(link_c))
    return bind(both, pick)


# --- URL join (RFC 3986 reference resolution as done by Python's urljoin) ---------------

_URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _url_clean(c: Column) -> Column:
    """What Python's urlsplit reads: leading control/space characters dropped, tabs and newlines removed."""
    return F.regexp_replace(F.regexp_replace(c, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _part(c: Column, i: int) -> Column:
    return F.regexp_extract(c, _URL_PARTS, i)


def _has(c: Column, marker: str) -> Column:
    pattern = {"query": r"^[^#]*\?", "fragment": "#", "netloc": r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"}[marker]
    return c.rlike(pattern)


def _remove_dots(segments: Column) -> Column:
    """Fold path segments: '..' pops, '.' is skipped, others are appended."""
    folded = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                        .when(s == ".", acc)
                        .otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segments, -1)
    return F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)


def resolve_url(base, link) -> Column:
    """``urljoin(base, link)`` for http(s) bases: handles ``//host``, ``/abs``, ``rel``, ``;params`` of the last segment,
    ``?q``, ``#f`` and dot segments. A link that carries its own scheme is returned unchanged."""
    base, link = _col(base), _col(link)
    cbase, clink = _url_clean(base), _url_clean(link)
    parts = F.struct(
        base.alias("base"), link.alias("link"),
        clink.alias("lc"),
        *[_part(cbase, i).alias(f"b{i}") for i in (1, 2, 4)],
        *[_part(clink, i).alias(f"l{i}") for i in (1, 2, 4, 5)],
        *[c for side, url in (("b", cbase), ("l", clink)) for c in _path_and_params(_part(url, 3), side)],
        _has(clink, "query").alias("lq"), _has(clink, "fragment").alias("lf"),
        _has(cbase, "query").alias("bq"), _has(clink, "netloc").alias("ln"))
    return bind(parts, _resolve)


def _path_and_params(path: Column, side: str) -> list[Column]:
    """The path without, and with ``;`` the parameters of its last segment ('' also where nothing follows the ``;``)."""
    split = r"(?s)^((?:.*/)?[^/;]*)(;.*)?$"
    params = F.regexp_extract(path, split, 2)
    return [F.regexp_extract(path, split, 1).alias(f"{side}3"), F.when(params == ";", "").otherwise(params).alias(f"{side}p")]


def _resolve(p: Column) -> Column:
    base, link = p["base"], p["link"]
    l_params = p["lp"]
    b_scheme, b_net, b_path, b_query = p["b1"], p["b2"], p["b3"], p["b4"]
    l_scheme, l_path, l_query, l_frag = p["l1"], p["l3"], p["l4"], p["l5"]
    l_has_q, l_has_f, b_has_q = p["lq"], p["lf"], p["bq"]

    def with_tail(prefix: Column, path: Column, query: Column, has_q: Column) -> Column:
        return F.concat(prefix, path,
                        F.when(has_q, F.concat(F.lit("?"), query)).otherwise(F.lit("")),
                        F.when(l_has_f, F.concat(F.lit("#"), l_frag)).otherwise(F.lit("")))

    authority = F.concat(b_scheme, F.lit("://"), b_net)

    def joined(segs: Column) -> Column:
        return bind(F.array_join(_remove_dots(segs), "/"), lambda j: bind(
            F.when(j == "", F.lit("/")).otherwise(j),
            lambda q: F.when(q.startswith("/"), q).otherwise(F.concat(F.lit("/"), q))))

    def relative_segments(bp: Column) -> Column:
        # Base directory segments + link segments, inner empty segments dropped.
        base_dir = F.split(bp, "/")
        base_dir = F.when(F.element_at(base_dir, -1) != "", F.slice(base_dir, 1, F.size(base_dir) - 1)).otherwise(base_dir)
        return bind(F.concat(base_dir, F.split(l_path, "/")), lambda segs: F.concat(
            F.slice(segs, 1, 1),
            F.filter(F.slice(segs, 2, F.greatest(F.size(segs) - 2, F.lit(0))), lambda s: s != ""),
            F.when(F.size(segs) > 1, F.slice(segs, -1, 1)).otherwise(F.array().cast("array<string>"))))

    return (F.when(link.isNull(), F.lit(None).cast("string"))
            .when(base.isNull() | (base == ""), link)
            .when((l_scheme != "") & (F.lower(l_scheme) != F.lower(b_scheme)), link)
            .when(link == "", base)
            # '//host/...' takes the base scheme; '///path' (empty host) is an absolute path
            .when(p["ln"] & (p["l2"] != ""),
                  with_tail(F.concat(b_scheme, F.lit("://"), p["l2"]), F.concat(l_path, l_params), l_query, l_has_q))
            .when((l_path == "") & (l_params == ""),
                  with_tail(authority, F.concat(b_path, p["bp"]), F.when(l_has_q, l_query).otherwise(b_query), l_has_q | b_has_q))
            .when(l_path.startswith("/"), with_tail(authority, F.concat(joined(F.split(l_path, "/")), l_params), l_query, l_has_q))
            .otherwise(with_tail(authority, F.concat(joined(relative_segments(b_path)), l_params), l_query, l_has_q)))


def resolve_link(link, feed_url) -> Column:
    """Links that do not start with 'http' are joined onto the feed URL; others pass unchanged."""
    return bind(F.struct(_col(link).alias("l"), _col(feed_url).alias("b")), lambda v: F.when(
        (v["l"] != "") & ~v["l"].startswith("http"), resolve_url(v["b"], v["l"])).otherwise(v["l"]))
