"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from fairwake.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))
_FAILED = ", ".join(
    f"CASE WHEN {r.measure} {r.comparison} {r.limit} THEN '{r.name}' END" for r in RULES
)

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
u AS (SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT r, i, a, lead(a) OVER x AS b, lead(a, 2) OVER x AS c FROM u WINDOW x AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g WHERE c IS NOT NULL),
p AS (SELECT r, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM c WHERE n > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letters
  FROM w LEFT JOIN p USING (r)
),
x AS (
  SELECT *, coalesce(word_chars / nullif(n_words, 0)::DOUBLE, 0) AS mean_word_chars,
    coalesce(n_symbols / nullif(word_chars, 0)::DOUBLE, 0) AS symbol_ratio,
    coalesce(n_stop / nullif(n_words, 0)::DOUBLE, 0) AS stop_word_ratio,
    coalesce(n_letters / nullif(n_words, 0)::DOUBLE, 0) AS letter_word_ratio,
    coalesce(n_dup_lines / nullif(n_lines, 0)::DOUBLE, 0) AS dup_line_ratio,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM m
),
f AS (SELECT *, concat_ws(',', {_FAILED}) AS failed FROM x)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND failed = '' AS kept, failed
FROM f
"""

EXACT = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
h AS (SELECT doc_id, length(text) AS n, sha256(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM t)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM h
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST)
"""

FILTERS = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
flags AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(w) < 200,
     100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
     regexp_matches(t, '[#$%&*|]'),
     coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)] AS f
  FROM d LEFT JOIN flags USING (doc_id)
),
c AS (
  SELECT part, f[1] AS a, f[2] AS b, f[3] AS c, f[4] AS d, f[5] AS e, f,
    count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x
  FROM m GROUP BY ALL
),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
),
s AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
r AS (
  SELECT part, o, step,
    sum(n) FILTER (NOT list_bool_or(list_transform(o[1:step], lambda i: f[i]))) AS kept,
    sum(n) FILTER (f[o[step]] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)) AS removed,
    sum(n) FILTER (f[o[step]] AND coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)) AS redundant,
    sum(n) FILTER (f[o[step]] AND len(list_filter(f, lambda v: v)) = 1) AS unique_fails,
    sum(g) FILTER (f[o[step]] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)) AS good_lost,
    sum(x) FILTER (f[o[step]] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)) AS toxic_lost
  FROM c, s GROUP BY part, o, step
)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i::BIGINT, 1)), '') AS filter_order,
  step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, o[step]), 0)::BIGINT AS shapley
FROM r
"""

STATEMENTS = {"op13_filter_audit": FILTERS, "op6_quality_rules": QUALITY, "op10_exact_dedup": EXACT}
