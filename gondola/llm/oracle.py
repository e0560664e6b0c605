"""DuckDB SQL for the numbered operators that SQL can express."""

from __future__ import annotations

from gondola.llm import host_reputation, line_winnow, quality_ledger

_WORD_SPACE = r"[ \t\n\x0B\f\r]+"

QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, list_filter(string_split_regex(text, '{_WORD_SPACE}'), lambda x: x <> '') AS ws FROM docs)
),
sizes AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY r),
windows AS (
  SELECT r, i, w, lead(w) OVER v AS w2, lead(w, 2) OVER v AS w3 FROM words WINDOW v AS (PARTITION BY r ORDER BY i)
),
repeated AS (
  SELECT r, i FROM windows WHERE w3 IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY r, w, w2, w3) > 1
),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
),
lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^ \t\n\x0B\f\r]') GROUP BY r
),
measured AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
    length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclaims
  FROM docs LEFT JOIN sizes USING (r) LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)
),
judged AS (
  SELECT *, ({' + '.join(f'CASE WHEN {rule.failed} THEN {1 << k} ELSE 0 END' for k, rule in enumerate(quality_ledger.RULES))})::BIGINT AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  failed_bits & {quality_ledger.mask(quality_ledger.POLICIES[quality_ledger.DEFAULT_POLICY])} = 0 AS kept,
  n_capitals, n_exclaims, failed_bits
FROM judged
"""

_TWO = ", ".join(f"'{s}'" for s in host_reputation.TWO_LABEL_SUFFIXES)
_LOW, _HIGH = host_reputation.RHO_RANGE


def _strength(level: str) -> str:
    return f"""(SELECT 1 / least(greatest(coalesce((sum((y - n * m) ** 2 / (m * (1 - m))) - sum(n))
      / nullif(sum(n * (n - 1)), 0), {host_reputation.DEFAULT_RHO}), {_LOW}), {_HIGH}) - 1 FROM {level} WHERE n > 0)"""


URL = rf"""
WITH urls AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM urls
),
outcomes AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
h0 AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS y, string_split(host, '.') AS p
  FROM parts LEFT JOIN outcomes USING (page_id) GROUP BY host
),
h1 AS (SELECT *, array_to_string(p[-2:], '.') IN ({_TWO}) AS two FROM h0),
h AS (
  SELECT host, n, y, array_to_string(CASE WHEN two THEN p[-3:] ELSE p[-2:] END, '.') AS domain,
    array_to_string(CASE WHEN two THEN p[-2:] ELSE p[-1:] END, '.') AS suffix
  FROM h1
),
s0 AS (SELECT suffix, sum(n) AS n, sum(y) AS y, (SELECT (sum(y) + 0.5::DOUBLE) / (sum(n) + 1) FROM h) AS m FROM h GROUP BY suffix),
s AS (SELECT suffix, (y + k * m) / (n + k) AS p FROM s0, (SELECT {_strength('s0')} AS k)),
d0 AS (SELECT g.*, s.p AS m FROM (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM h GROUP BY domain, suffix) g JOIN s USING (suffix)),
d AS (SELECT domain, suffix, (y + k * m) / (n + k) AS p FROM d0, (SELECT {_strength('d0')} AS k)),
h2 AS (SELECT h.*, d.p AS m FROM h JOIN d USING (domain, suffix)),
known AS (
  SELECT host, n, y, (y + k * m) / (n + k) AS p, n + k AS weight FROM h2, (SELECT {_strength('h2')} AS k)
),
rules(verdict, rule) AS (VALUES {', '.join(str(r) for r in host_reputation.RULES)}),
split AS (SELECT *, split_part(rule, '/', 1) AS rh, substr(rule, length(split_part(rule, '/', 1)) + 1) AS rp FROM rules),
best AS (
  SELECT host, path, min_by(rule, (-length(rule), rule)) AS rule, min_by(verdict, (-length(rule), rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts), split
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN p - {host_reputation.Z} * sqrt(p * (1 - p) / (weight + 1)) > {host_reputation.MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  n::BIGINT AS n_labels, y::BIGINT AS n_bad, round(p, 6) AS bad_mean,
  round(p - {host_reputation.Z} * sqrt(p * (1 - p) / (weight + 1)), 6) AS bad_bound
FROM parts JOIN known USING (host) LEFT JOIN best USING (host, path)
"""

LINES = rf"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS line FROM split
),
counted AS (
  SELECT *, len(list_filter(string_split_regex(l, '{_WORD_SPACE}'), lambda x: x <> '')) AS n FROM lines
),
pairs AS (
  SELECT doc_id, line, lead(line) OVER v AS line2, l || chr(10) || lead(l) OVER v AS content, n + lead(n) OVER v AS n
  FROM counted WHERE n > 0 WINDOW v AS (PARTITION BY doc_id ORDER BY line)
),
windows AS (
  SELECT doc_id, line, line2, content FROM pairs WHERE n >= {line_winnow.MIN_WORDS}
  UNION ALL SELECT doc_id, line, line, l FROM counted WHERE n >= {line_winnow.LONG_WORDS}
),
later AS (
  SELECT * FROM windows
  QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, line) > 1
),
removed AS (SELECT doc_id, line FROM later UNION SELECT doc_id, line2 FROM later),
texts AS (
  SELECT doc_id, count(r.line) AS n_removed, string_agg(l, chr(10) ORDER BY line) FILTER (r.line IS NULL) AS text
  FROM lines LEFT JOIN removed r USING (doc_id, line) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN texts t USING (doc_id)
"""

SQL: dict[str, str] = {
    "op1_quality_rules": QUALITY, "op2_url_filter": URL, "op9_line_dedup": LINES,
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
