"""DuckDB oracle for tokenising, resolving and assembling.

Written from the rule semantics, not from the Spark plan: RE2 has no
lookahead, so the hyphen split of a morpheme scans each piece right to
left (a hyphen is kept when the nearest parenthesis to its right is a
closing one); resolution is one CASE over left joins to the lookups.
"""

from __future__ import annotations

from scribal.functions import rule_values as V
from scribal.functions.text import PY_WHITESPACE
from scribal.operators import clean as C
from scribal.plans.fixtures import marked_sql
from scribal.plans.oracle_sql import chain_sql, fold_sql, q
from scribal.plans.q_clean import TEST_PATCHES
from scribal.plans.q_lookups import VOCAB_SQL

_BASE = f"SELECT doc_id, lang, {marked_sql()} AS t FROM documents"
_CTES, _LAST = chain_sql(_BASE, C.CHAIN, "t", "doc_id", TEST_PATCHES, prefix="k")
_RESIDUE = fold_sql("t", [(tok, "") for tok in V.PUBLISHED_TOKENS])
_SPECIALS = "(" + ", ".join(q(s) for s in V.SPECIAL_TOKENS) + ")"
_WS = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def _values(pairs, a="k", b="v"):
    rows = ", ".join(f"({q(x)}, {q(y)})" for x, y in pairs)
    return f"(VALUES {rows}) AS t({a}, {b})"


_STRUCT = "STRUCT(reading VARCHAR, cands VARCHAR[], cat VARCHAR)"


def _res(reading: str, cands: str, cat: str = "NULL") -> str:
    return f"CAST({{'reading': {reading}, 'cands': {cands}, 'cat': {cat}}} AS {_STRUCT})"


_EMPTY = "CAST([] AS VARCHAR[])"
_UPPER = "(regexp_matches(m0, '\\p{Lu}') AND NOT regexp_matches(m0, '[\\p{Ll}\\p{Lt}]'))"
_NUM = "^\\d+(/\\d+)?(\\.\\d+)?(\\s*\\([^)]+\\))?$"

_SCAN = ("list_reduce(list_reverse(string_split(p, '')), lambda acc, c: {'s': CASE WHEN c = ')' THEN true "
         "WHEN c = '(' THEN false ELSE acc.s END, 'o': (CASE WHEN c = '-' AND acc.s THEN chr(2) ELSE c END) || acc.o}, "
         "{'s': false, 'o': ''}).o")

RESOLVE_CTES = ",\n".join(_CTES) + f""",
texts AS MATERIALIZED (SELECT doc_id, lang, {fold_sql('t', V.SIGN_LIST_REPLACEMENTS)} AS tr FROM {_LAST} WHERE {_RESIDUE} <> ''),
toks AS MATERIALIZED (
  SELECT doc_id, CAST(u.pos - 1 AS INTEGER) AS word_pos, u.wf AS wordform
  FROM texts, unnest(list_filter(string_split(regexp_replace(replace(replace(tr, chr(10), ' ' || chr(10) || ' '),
       '...', ' ... '), ' +', ' ', 'g'), ' '), lambda x: x NOT IN ('', '|', '.|'))) WITH ORDINALITY AS u(wf, pos)
),
wfs AS (SELECT DISTINCT wordform FROM toks WHERE wordform NOT IN {_SPECIALS}),
nums AS (SELECT * FROM {_values(V.READING_FIXES)}),
wfx AS (
  SELECT w.wordform, CASE WHEN n1.v IS NOT NULL THEN n1.v
    WHEN contains(w.wordform, '-') AND n2.v IS NOT NULL THEN n2.v || '-' || substr(w.wordform, strpos(w.wordform, '-') + 1)
    ELSE w.wordform END AS x
  FROM wfs w LEFT JOIN nums n1 ON n1.k = w.wordform LEFT JOIN nums n2 ON n2.k = split_part(w.wordform, '-', 1)
),
pieces AS (
  SELECT wordform, list_filter(regexp_split_to_array(regexp_replace(x, '(\\{{.*?\\}})', chr(1) || '\\1' || chr(1), 'g'),
         '[\\x01 ]'), lambda p: p <> '') AS ps FROM wfx
),
morphs AS MATERIALIZED (
  SELECT wordform, CAST(u.pos - 1 AS INTEGER) AS morph_pos, u.m AS morpheme FROM (
    SELECT wordform, list_filter(flatten(list_transform(ps, lambda p: list_transform(string_split({_SCAN}, '-'),
           lambda y: replace(y, chr(2), '-')))), lambda y: y <> '') AS ms FROM pieces
  ), unnest(ms) WITH ORDINALITY AS u(m, pos)
),
{VOCAB_SQL.strip()},
gi AS (SELECT glyph_name, coalesce(min(glyph) FILTER (WHERE glyph <> ''), '') AS glyph FROM gpairs GROUP BY glyph_name),
inv AS (SELECT glyph_name, list_sort(list_distinct(list(reading))) AS readings
        FROM (SELECT reading, unnest(names) AS glyph_name FROM rmerged) GROUP BY glyph_name),
mk AS (
  SELECT morpheme, m0, lower(m0) AS k_lower, replace(replace(m0, '{{', ''), '}}', '') AS k_strip,
         split_part(m0, '(', 1) AS k_head, replace(string_split(m0, '(')[2], ')', '') AS k_bname,
         contains(m0, '(') AND contains(m0, ')') AS has_parens
  FROM (SELECT DISTINCT morpheme, CASE WHEN morpheme = {q(V.READING_RESPELL[0])} THEN {q(V.READING_RESPELL[1])}
        ELSE morpheme END AS m0 FROM morphs)
),
pr AS (
  SELECT mk.*, a.names AS r_m0, b.names AS r_lower, c.names AS r_strip, d.names AS r_head, e.readings AS inv,
         g.glyph_name IS NOT NULL AS is_name
  FROM mk LEFT JOIN rmerged a ON a.reading = mk.m0 LEFT JOIN rmerged b ON b.reading = mk.k_lower
  LEFT JOIN rmerged c ON c.reading = mk.k_strip LEFT JOIN rmerged d ON d.reading = mk.k_head
  LEFT JOIN inv e ON e.glyph_name = mk.k_bname LEFT JOIN gi g ON g.glyph_name = mk.m0
),
ch AS (
  SELECT morpheme, CASE
    WHEN m0 IN ('x', 'n', 'X', 'N') THEN {_res("'...'", "['...']")}
    WHEN regexp_matches(m0, '{_NUM}') THEN CASE
      WHEN r_m0 IS NOT NULL THEN {_res('m0', 'r_m0')}
      WHEN r_lower IS NOT NULL THEN {_res('k_lower', 'r_lower')}
      WHEN is_name THEN {_res('m0', '[m0]')}
      ELSE {_res('m0', _EMPTY, "'unk_number'")} END
    WHEN is_name THEN {_res("'<unk>'", '[m0]')}
    WHEN r_strip IS NOT NULL THEN {_res('m0', 'r_strip')}
    WHEN {_UPPER} THEN CASE WHEN r_lower IS NOT NULL THEN {_res("'<unk>'", 'r_lower')}
                            ELSE {_res("'<unk>'", _EMPTY, "'unk_sign_name'")} END
    WHEN has_parens AND r_head IS NOT NULL AND len(r_head) = 1 THEN {_res('k_head', 'r_head')}
    WHEN has_parens AND r_head IS NOT NULL AND list_contains(r_head, k_bname) THEN {_res('k_head', '[k_bname]')}
    WHEN has_parens AND inv IS NOT NULL AND len(inv) = 1 THEN {_res('inv[1]', '[k_bname]')}
    ELSE {_res('m0', _EMPTY, "'unk_other'")} END AS c
  FROM pr
),
r1 AS (
  SELECT morpheme, c.reading AS reading, c.cat AS unk_cat,
         CASE WHEN len(c.cands) = 1 THEN c.cands[1] ELSE '<unk>' END AS name FROM ch
),
gnr AS (SELECT * FROM {_values(V.GLYPH_NAME_REPLACEMENTS)}),
r2 AS (
  SELECT r1.*, CASE WHEN name = '<unk>' THEN '<unk>' ELSE reading END AS post_reading,
         name <> '<unk>' AS converted, name = 'N' AS dropped, coalesce(gnr.v, name) AS glyph_name
  FROM r1 LEFT JOIN gnr ON gnr.k = r1.name
),
r3 AS (
  SELECT r2.*, gi.glyph AS g0,
    CASE WHEN post_reading = '<unk>' OR dropped THEN NULL WHEN r2.glyph_name IN {_SPECIALS} THEN 'special'
         WHEN gi.glyph IS NULL THEN 'not_in_map' WHEN gi.glyph = '' THEN 'no_codepoint' ELSE 'found' END AS glyph_status,
    CASE WHEN r2.glyph_name IN {_SPECIALS} THEN r2.glyph_name WHEN gi.glyph IS NULL OR gi.glyph = '' THEN '<unk>'
         ELSE gi.glyph END AS gl
  FROM r2 LEFT JOIN gi ON gi.glyph_name = r2.glyph_name
),
res AS (
  SELECT *, post_reading = '<unk>' OR gl = '<unk>' OR contains(gl, 'X') AS unk3 FROM r3
),
details AS MATERIALIZED (
  SELECT m.wordform, m.morph_pos, m.morpheme, res.reading, res.unk_cat, res.name, res.converted, res.dropped,
         res.glyph_name, res.glyph_status,
         CASE WHEN unk3 THEN '<unk>' ELSE post_reading END AS out_reading,
         CASE WHEN unk3 THEN '<unk>' ELSE res.glyph_name END AS out_name,
         CASE WHEN unk3 THEN '<unk>' ELSE gl END AS out_glyph
  FROM morphs m JOIN res USING (morpheme)
),
wpieces AS (
  SELECT wordform,
    coalesce(string_agg(out_reading, '-' ORDER BY morph_pos) FILTER (WHERE NOT dropped), '') AS p_reading,
    coalesce(string_agg(out_name, ' ' ORDER BY morph_pos) FILTER (WHERE NOT dropped), '') AS p_name,
    coalesce(string_agg(out_glyph, '' ORDER BY morph_pos) FILTER (WHERE NOT dropped), '') AS p_glyph
  FROM details GROUP BY wordform
),
tp AS (
  SELECT t.doc_id, t.word_pos,
    CASE WHEN t.wordform IN {_SPECIALS} THEN t.wordform ELSE coalesce(w.p_reading, '') END AS p_reading,
    CASE WHEN t.wordform IN {_SPECIALS} THEN t.wordform ELSE coalesce(w.p_name, '') END AS p_name,
    CASE WHEN t.wordform IN {_SPECIALS} THEN t.wordform ELSE coalesce(w.p_glyph, '') END AS p_glyph
  FROM toks t LEFT JOIN wpieces w USING (wordform)
),
joined AS (
  SELECT x.doc_id, x.lang, x.tr,
    trim(coalesce(string_agg(p_reading, ' ' ORDER BY word_pos), ''), {_WS}) AS a_t,
    trim(coalesce(string_agg(p_name, ' ' ORDER BY word_pos), ''), {_WS}) AS a_n,
    trim(coalesce(string_agg(p_glyph, ' ' ORDER BY word_pos), ''), {_WS}) AS a_g
  FROM texts x LEFT JOIN tp USING (doc_id) GROUP BY x.doc_id, x.lang, x.tr
),
parallel AS MATERIALIZED (
  SELECT doc_id, lang,
    regexp_replace({fold_sql("regexp_replace(a_t, ' *' || chr(10) || ' *', chr(10), 'g')",
                             [("-{", "{"), ("}-", "}"), ("<unk>-", "<unk> "), ("-<unk>", " <unk>")])},
                   '( *\\.{{3,}} *)+', '...', 'g') AS transliteration,
    regexp_replace(a_n, '( *\\.{{3,}} *)+', '...', 'g') AS glyph_names,
    replace(regexp_replace(a_g, '( *\\.{{3,}} *)+', '...', 'g'), ' ', '') AS glyphs
  FROM joined
),
wcount AS (SELECT wordform, count(*) AS cnt FROM toks GROUP BY wordform),
occ AS (SELECT d.*, w.cnt FROM details d JOIN wcount w USING (wordform))"""


def sql(final: str) -> str:
    return "WITH " + RESOLVE_CTES + "\n" + final


TOKENS_SQL = sql("SELECT doc_id, word_pos, wordform FROM toks")
MORPHS_SQL = sql("SELECT wordform, morph_pos, morpheme FROM morphs")
RESOLVE_SQL = sql("SELECT wordform, morph_pos, morpheme, reading, name, converted, glyph_status, out_reading, "
                  "out_name, out_glyph FROM details")
ASSEMBLE_SQL = sql("SELECT doc_id, lang, transliteration, glyph_names, glyphs FROM parallel")
DEDUP_SQL = sql("""SELECT doc_id, md5(transliteration) AS t_md5, md5(glyphs) AS g_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY glyphs ORDER BY doc_id) AS r2 FROM (
    SELECT *, row_number() OVER (PARTITION BY transliteration ORDER BY doc_id) AS r1 FROM parallel
  ) WHERE r1 = 1
) WHERE r2 = 1""")


def _pct(ok: str, bad: str) -> str:
    return (f"CAST(round_even(CAST({ok} AS DECIMAL(38, 10)) * 100 / nullif({ok} + {bad}, 0), 2) AS DOUBLE)")


RATES_SQL = sql(f"""SELECT measure, CAST(ok AS BIGINT) AS converted, CAST(bad AS BIGINT) AS not_converted,
  {_pct('ok', 'bad')} AS pct_converted, {_pct('bad', 'ok')} AS pct_not_converted FROM (
  SELECT 'readings' AS measure, coalesce(sum(cnt) FILTER (WHERE converted), 0) AS ok,
         coalesce(sum(cnt) FILTER (WHERE NOT converted), 0) AS bad FROM occ
  UNION ALL
  SELECT 'names', coalesce(sum(cnt) FILTER (WHERE glyph_status = 'found'), 0),
         coalesce(sum(cnt) FILTER (WHERE glyph_status IN ('not_in_map', 'no_codepoint')), 0) FROM occ)""")
OBSERVED_SQL = sql(f"""SELECT out_glyph AS glyph, out_reading AS reading, CAST(sum(cnt) AS BIGINT) AS n FROM occ
WHERE NOT dropped AND out_reading NOT IN {_SPECIALS} GROUP BY out_glyph, out_reading""")
GLYPH_COUNT_SQL = sql(f"""SELECT count(*) AS n_rows, CAST(coalesce(sum(length({fold_sql(
    "coalesce(glyphs, '')", [(t, '') for t in V.GLYPH_COUNT_EXCLUDED] + [(' ', '')])})), 0) AS BIGINT) AS n_glyphs
FROM parallel""")

TOP_SQL = sql("""SELECT category, item, CAST(n AS BIGINT) AS n, category_total FROM (
  SELECT *, CAST(sum(n) OVER (PARTITION BY category) AS BIGINT) AS category_total, row_number() OVER (PARTITION BY category ORDER BY n DESC, seen ASC) AS rk FROM (
    SELECT category, item, sum(cnt) AS n, min({'f': first, 'm': morph_pos}) AS seen FROM (
      SELECT unk_cat AS category, morpheme AS item, cnt, first, morph_pos FROM occ2 WHERE unk_cat IS NOT NULL
      UNION ALL
      SELECT glyph_status, glyph_name, cnt, first, morph_pos FROM occ2 WHERE glyph_status IN ('not_in_map', 'no_codepoint')
    ) GROUP BY category, item
  )
) WHERE rk <= 20""").replace("\nSELECT category, item, CAST(n", """,
wfirst AS (SELECT wordform, min({'d': doc_id, 'w': word_pos}) AS first FROM toks GROUP BY wordform),
occ2 AS (SELECT o.*, f.first FROM occ o JOIN wfirst f USING (wordform))
SELECT category, item, CAST(n""", 1)

FINGERPRINT_SQL = sql("""SELECT count(*) AS n_rows, CAST(coalesce(sum(CAST(('0x' || substr(h, 1, 15)) AS BIGINT)::HUGEINT), 0)
  AS VARCHAR) AS fingerprint FROM (
  SELECT sha256(concat_ws(chr(31), coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(lang, ''),
         coalesce(transliteration, ''), coalesce(glyph_names, ''), coalesce(glyphs, ''))) AS h FROM parallel)""")
