"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP11 = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
d AS (SELECT rid, doc_id, terms, len(terms) AS n FROM t WHERE len(terms) > 0),
s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM d),
q AS (SELECT item_id, term, count(*) AS uses FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY rid, doc_id, n, term),
w AS (SELECT term, floor(1000 * ln((2 * max(s.nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, s GROUP BY term),
i AS (SELECT rid, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * s.nn) // s.ll))) AS impact
  FROM tf, s),
scored AS (SELECT q.item_id, i.rid, i.doc_id, sum(q.uses * w.w * i.impact)::BIGINT AS score
  FROM q JOIN w USING (term) JOIN i USING (term) GROUP BY q.item_id, i.rid, i.doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII string, bit by bit."""
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {step}), 4294967295)"


def _repair_step() -> str:
    """The state string after one row. A state string holds, for each of the four states, nine digits of cost and the
    edits' initials, or nothing; the least string is the cheapest way and of those the ASCII-least."""
    v = [f"nullif(split_part(acc, '|', {q + 1}), '')" for q in range(4)]

    def way(value: str, cost: str, letters: str) -> str:
        return f"(lpad((substr({value}, 1, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || substr({value}, 10) || '{letters}')"

    def least(*ways: str) -> str:
        return f"least({', '.join(ways)})"

    start, system = v[0], v[1]
    user = least(v[2], *[way(v[q], "3", "I") for q in (0, 1, 3)])
    assistant = least(v[3], way(v[2], "3", "I"), *[way(v[q], "6", "II") for q in (0, 1)])
    kept = "position(x IN 'SUAX') > 0"  # a truncated row
    extra = f"(CASE WHEN {kept} THEN 3 ELSE 0 END)"
    gone = "position(x IN '1234') > 0"

    def moves(sources: list[str], initial: str, retype: bool) -> list[str]:
        out = [f"CASE WHEN lower(x) = '{initial}' THEN {way(s, extra, 'K')} END" for s in sources]
        return out + [f"CASE WHEN NOT {gone} THEN {way(s, f'(3 + {extra})', 'R')} END" for s in sources if retype]

    new = [way(start, "4", "D"), least(way(system, "4", "D"), *moves([start], "s", False)),
           least(way(user, "4", "D"), *moves([start, system, assistant], "u", True)),
           least(way(assistant, "4", "D"), *moves([user], "a", True))]
    return " || '|' || ".join(f"coalesce({n}, '')" for n in new)


# The repaired rows follow from the edits: the place of an edit in the repaired conversation is the number of edits
# before it that are no deletions, and its length is odd just where a system row is first.
OP12 = f"""
WITH d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN k = 0 THEN [] WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS mark FROM rows_),
f AS (
  SELECT *, CASE WHEN mark = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN mark NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    CASE WHEN role[1:1] IN ('s', 'u', 'a') THEN role[1:1] ELSE 'x' END AS initial,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY pos) AS previous FROM o),
c AS (
  SELECT conv_id, (coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0))::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pos > 1 AND previous || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal,
    list(role ORDER BY pos) AS roles, list(text ORDER BY pos) AS texts,
    list_reduce(list_concat(['000000000|||'], list(CASE WHEN fault IN ('blank', 'duplicate') THEN translate(initial, 'suax', '1234')
      WHEN fault = 'truncated' THEN upper(initial) ELSE initial END ORDER BY pos)), lambda acc, x: {_repair_step()}) AS acc
  FROM f GROUP BY conv_id),
w AS (SELECT *, nullif(split_part(acc, '|', 1), '') AS v0, nullif(split_part(acc, '|', 2), '') AS v1,
    nullif(split_part(acc, '|', 3), '') AS v2, nullif(split_part(acc, '|', 4), '') AS v3 FROM c),
b AS (SELECT *, least(v0, v3,
    lpad((substr(v2, 1, 9)::INTEGER + 3)::VARCHAR, 9, '0') || substr(v2, 10) || 'I',
    lpad((substr(v1, 1, 9)::INTEGER + 6)::VARCHAR, 9, '0') || substr(v1, 10) || 'II') AS best FROM w),
e AS (SELECT *, substr(best, 1, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM b),
p AS (SELECT *, split(audit, '') AS letters, length(replace(audit, 'D', '')) % 2 AS system FROM e),
r AS (SELECT * EXCLUDE (letters), list_transform(letters, lambda s, i: {{
    'edit': s, 'row': length(replace(substr(audit, 1, i), 'I', '')),
    'place': length(replace(substr(audit, 1, i - 1), 'D', ''))}}) AS steps FROM p),
g AS (SELECT *, array_to_string(list_transform(list_filter(steps, lambda s: s.edit <> 'D'), lambda s:
    CASE WHEN s.edit = 'K' THEN roles[s.row] WHEN (s.place - system) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN s.edit = 'I' THEN '' ELSE texts[s.row] END), chr(10)) AS repaired FROM r)
SELECT n.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) n LEFT JOIN g ON n.conv_id IS NOT DISTINCT FROM g.conv_id
"""
