"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from scribal.llm import lexical_search, minhash, mixing, ngram_join, quality_rules

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _rule_sql(rules) -> str:
    parts = []
    for name, low, high in rules:
        if low is not None:
            parts.append(f"{name} >= {low}")
        if high is not None:
            parts.append(f"{name} <= {high}")
    return " AND ".join(parts)


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
QUALITY_RULES_SQL = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
lined AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM base),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: struct_pack(p := i, k := w[i:i+7]))) AS x
  FROM base WHERE len(w) >= 9),
twice AS (
  SELECT doc_id, unnest(list(x.p)) AS p FROM windows GROUP BY doc_id, x.k HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM twice) GROUP BY doc_id),
f AS (
  SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(ln) AS n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '([#*$%&|<>]|[!?]{{2,}})$'))) AS marked,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '\p{{Ll}}'))) AS capital,
    len(list_filter(w, lambda x: list_contains([{_STOPS}], lower(x)))) AS stops,
    len(list_filter(ln, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS bullets,
    len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS ellipses
  FROM lined l LEFT JOIN covered c USING (doc_id)),
r AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
    CASE WHEN n_words > 0 THEN marked / n_words ELSE 0 END AS marked_word_ratio,
    CASE WHEN n_words > 0 THEN capital / n_words ELSE 0 END AS capital_word_ratio,
    CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_word_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0 END AS bullet_line_ratio,
    CASE WHEN n_lines > 0 THEN ellipses / n_lines ELSE 0 END AS ellipsis_line_ratio,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_word_ratio,
    (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND {_rule_sql(quality_rules.THRESHOLDS)}) AS kept
FROM r
"""

#: The mix as plain windows over whole sources (DuckDB need not spread them).
_W = ", ".join(str(w) for w in mixing.WEIGHTS)
MIXING_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [{_W}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS w FROM d GROUP BY source),
l AS (SELECT *, {mixing.MAX_COPIES} * source_size AS cap, {mixing.MAX_COPIES} * source_size / w AS level FROM s),
r AS (
  SELECT *, {mixing.SHARE_PERCENT} * sum(source_size) OVER () - 100 * coalesce(sum(cap) OVER (
      ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM l),
q AS (SELECT *, 100 * cap * ws <= w * rest AS filled FROM r),
one AS (SELECT rest, ws FROM q WHERE NOT filled ORDER BY level, source NULLS LAST LIMIT 1),
t AS (
  SELECT q.source, source_size, CASE WHEN filled THEN CAST(cap AS DOUBLE)
    ELSE CAST(w * (SELECT rest FROM one) AS DOUBLE) / CAST(100 * (SELECT ws FROM one) AS DOUBLE) END AS target FROM q),
u AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0
      THEN CAST(floor(target / source_size * {float(mixing.UNIT)}) AS BIGINT) ELSE 0 END AS units,
    CAST('0x' || substr(md5('{mixing.SEED}/' || coalesce('s' || d.source, 'null')), 1, 6) AS BIGINT) AS off
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, off + CAST(sum(units) OVER (PARTITION BY source ORDER BY size, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM u)
SELECT doc_id, size, source_size, target,
  size * ((upto >> {mixing.UNIT_BITS}) - ((upto - units) >> {mixing.UNIT_BITS})) AS taken
FROM c
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Every pair with a common shingle is counted; components by recursion.
NGRAM_JOIN_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {ngram_join.WIDTH} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {ngram_join.WIDTH - 2}), lambda i: array_to_string(w[i:i+{ngram_join.WIDTH - 1}], ' ')) END) AS k FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= {ngram_join.PERCENT} * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""

#: As above, and only pairs whose sizes fit are counted.
MINHASH_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < {minhash.WIDTH} THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '')
    ELSE list_transform(range(1, len(w) - {minhash.WIDTH - 2}), lambda i: array_to_string(w[i:i+{minhash.WIDTH - 1}], ' ')) END) AS k FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
z AS (SELECT s.doc_id, k, n FROM s JOIN n USING (doc_id)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS x, b.n AS y, count(*) AS c FROM z a JOIN z b ON a.k = b.k AND a.doc_id <> b.doc_id
  AND 100 * least(a.n, b.n) >= {minhash.PERCENT} * greatest(a.n, b.n) GROUP BY 1, 2, 3, 4),
l AS (SELECT a, b FROM p WHERE 100 * c >= {minhash.PERCENT} * (x + y - c)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id, r.doc_id = min(r.c) AS kept
FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: Every document is scored for every item.
LEXICAL_SEARCH_SQL = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
l AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM l),
f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, s GROUP BY term, nn),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
r AS (
  SELECT item_id, f.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN l ON f.doc_id = l.doc_id, s GROUP BY item_id, f.doc_id),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {lexical_search.TOP}
"""
