"""Driver queries for tree ingest.

Trees are built from ``conversations``: one text per conversation, one
chunk per turn, a line-start discontinuity per line and one lemma per
word. Capitalised words open a break and words ending in a comma close
one (so the bracket repair has work); long words carry a fragment.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scribal.operators.tree import (
    assemble_text,
    discontinuity_token,
    flatten_tree,
    node_tokens,
    repair_brackets,
    tree_rejects,
)
from scribal.plans.fixtures import table
from scribal.plans.registry import register
from scribal.session import materialize


def _word_json(w: Column, lang: Column) -> Column:
    """A lemma; its break marks are JSON strings, booleans and numbers, of
    which null, false, 0 and "" mark no break but the string "0" does."""
    truthy = F.when(F.length(w) % 3 == 0, F.lit('"0"')).when(F.length(w) % 3 == 1, F.lit("true")).otherwise(F.lit('"1"'))
    falsy = F.when(F.length(w) % 4 == 0, F.lit("false")).when(F.length(w) % 4 == 1, F.lit("0")).when(F.length(w) % 4 == 2, F.lit('""'))
    start = F.parse_json(F.when(w.rlike("^[A-Z]"), truthy).otherwise(falsy))
    end = F.parse_json(F.when(w.endswith(","), truthy).otherwise(falsy))
    none = F.parse_json(F.lit(None).cast("string"))
    gdl = F.array(F.struct(start.alias("breakStart"), none.alias("breakEnd")), F.struct(none.alias("breakStart"), end.alias("breakEnd")))
    node = F.struct(
        F.lit("l").alias("node"), F.lit("x").alias("id"), F.lit("r").alias("ref"), F.lit("i").alias("inst"),
        F.when(F.length(w) > 12, F.substring(w, 1, 6)).alias("frag"),
        F.struct(w.alias("form"), lang.alias("lang"), gdl.alias("gdl")).alias("f"),
        F.array().cast("array<string>").alias("props"),
    )
    return F.to_json(node)


def conversation_trees(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    lang = F.when(F.col("role") == "user", F.lit("sux")).otherwise(F.lit("sux-x-emesal"))
    line_start = F.lit('{"node":"d","type":"line-start"}')

    def line_json(line):
        words = F.filter(F.split(line, " ", -1), lambda w: w != "")
        return F.concat(line_start, F.lit(","), F.array_join(F.transform(words, lambda w: _word_json(w, lang)), ","))

    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda ln: F.trim(ln) != "")
    extra = (
        F.when(F.col("turn") % 4 == 1, F.lit(',{"node":"d","type":"nonx","state":"blank","scope":"space"}'))
        .when(F.col("turn") % 4 == 2, F.lit(',{"node":"d","type":"nonx","state":"missing"}'))
        .when(F.col("turn") % 4 == 3, F.lit(',{"node":"ll","id":"y","choices":[]}'))
        .otherwise(F.lit(',{"linkbase":[]}'))
    )
    surface = F.when(F.col("turn") % 2 == 0, F.lit('{"node":"d","type":"surface"},')).otherwise(F.lit(""))
    turn_json = F.concat(
        F.lit('{"node":"c","type":"discourse","id":"t","cdl":['), surface,
        F.array_join(F.transform(lines, line_json), ","), extra, F.lit("]}"),
    )
    per_conv = conv.select("conv_id", "turn", turn_json.alias("tj")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "tj"))).alias("turns")
    )
    body = F.array_join(F.transform("turns", lambda s: s["tj"]), ",")
    doc = F.concat(F.lit('{"cdl":[{"node":"c","type":"text","id":"root","cdl":['), body, F.lit("]}]}"))
    return per_conv.select(F.col("conv_id").alias("id"), doc.alias("json"))


_E = "CAST([] AS VARCHAR[])"
# the node kinds each turn chunk holds, in order, derived from the turn
_FLAT_SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ti,
    list_concat(list_concat(CASE WHEN turn % 2 = 0 THEN ['d'] ELSE {_E} END,
      flatten(list_transform(list_filter(string_split(text, chr(10)), lambda ln: trim(ln) <> ''),
        lambda ln: list_concat(['d'], list_transform(list_filter(string_split(ln, ' '), lambda w: w <> ''),
                                                     lambda w: 'l'))))),
      [CASE turn % 4 WHEN 1 THEN 'd' WHEN 2 THEN 'd' WHEN 3 THEN 'll' ELSE 'linkbase' END]) AS kinds
  FROM conversations
)
SELECT DISTINCT conv_id AS id, '0' AS path, 'c' AS kind FROM conversations
UNION ALL
SELECT conv_id, '0.' || CAST(ti AS VARCHAR), 'c' FROM t
UNION ALL
SELECT conv_id, '0.' || CAST(ti AS VARCHAR) || '.' || CAST(u.pos - 1 AS VARCHAR), u.k
FROM t, unnest(kinds) WITH ORDINALITY AS u(k, pos)
"""


@register("flatten_tree", _FLAT_SQL, "N1 N2")
def flatten_tree_q(spark, sf_dir):
    nodes = flatten_tree(conversation_trees(spark, sf_dir))
    toks = node_tokens(nodes)
    return toks.select("id", F.array_join(F.transform("path", lambda p: p.cast("string")), ".").alias("path"), "kind")


def _assemble_sql() -> str:
    from scribal.functions.text import PY_WHITESPACE

    ws = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)
    nl = "chr(10)"
    return f"""
WITH t AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ti FROM conversations
), lines AS (
  SELECT conv_id, ti, role, l.ln, l.li FROM t,
    unnest(list_filter(string_split(text, {nl}), lambda x: trim(x) <> '')) WITH ORDINALITY AS l(ln, li)
), words AS (
  SELECT conv_id, ti, role, li, ww.w, ww.wi FROM lines,
    unnest(list_filter(string_split(ln, ' '), lambda x: x <> '')) WITH ORDINALITY AS ww(w, wi)
), a AS (
  SELECT *, CASE WHEN length(w) > 12 THEN substr(w, 1, 6) ELSE w END AS t,
    (CASE WHEN regexp_matches(w, '^[A-Z]') THEN '[' ELSE '' END) || (CASE WHEN suffix(w, ',') THEN ']' ELSE '' END) AS ideal,
    CASE WHEN role = 'user' THEN 'sux' ELSE 'sux-x-emesal' END AS lang
  FROM words
),{_repair_ctes('a')},
toks AS (
  SELECT conv_id, ti, 0 AS s1, 0 AS s2, 0 AS s3, '#SURFACE#' AS tok FROM t WHERE turn % 2 = 0
  UNION ALL SELECT conv_id, ti, 1, li, 0, {nl} FROM lines
  UNION ALL SELECT conv_id, ti, 1, li, wi, repaired FROM rep
  UNION ALL SELECT conv_id, ti, 2, 0, 0, CASE turn % 4 WHEN 1 THEN {nl} || '#BLANK_SPACE#' || {nl}
                                           WHEN 2 THEN {nl} || '#MISSING#' || {nl} END FROM t
), joined AS (
  SELECT c.conv_id,
    coalesce(string_agg(tok, ' ' ORDER BY ti, s1, s2, s3) FILTER (WHERE tok IS NOT NULL AND tok <> ''), '') AS j
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN toks USING (conv_id) GROUP BY c.conv_id
), surf AS (
  SELECT conv_id, list_filter(list_transform(string_split(j, '#SURFACE#'), lambda x: trim(x, {ws})),
    lambda x: replace(replace(regexp_replace(x, '#\\S*?#', '', 'g'), {nl}, ''), ' ', '') <> '') AS kept
  FROM joined
), txt AS (
  SELECT conv_id, CASE WHEN len(kept) > 0 THEN '#SURFACE#' || {nl} || array_to_string(kept, {nl} || '#SURFACE#' || {nl})
                       ELSE '' END AS x FROM surf
), langs AS (
  SELECT conv_id, string_agg(DISTINCT lang, ', ' ORDER BY lang) AS langs FROM a GROUP BY conv_id
)
SELECT txt.conv_id AS id,
  trim(regexp_replace(regexp_replace(regexp_replace(x, ' *' || {nl} || ' *', {nl}, 'g'), {nl} || '+', {nl}, 'g'),
       ' +', ' ', 'g'), {ws}) AS transliteration,
  coalesce(langs.langs, '') AS langs
FROM txt LEFT JOIN langs USING (conv_id)
"""


def assemble_text_q(spark, sf_dir):
    nodes = flatten_tree(conversation_trees(spark, sf_dir))
    return assemble_text(node_tokens(nodes))


# ---- N3: flat discontinuity nodes, one per conversation turn -------------
_D_TYPE = ("CASE turn % 6 WHEN 0 THEN 'object' WHEN 1 THEN 'line-start' WHEN 2 THEN 'column' "
           "WHEN 3 THEN 'surface' WHEN 4 THEN 'nonx' ELSE 'cell-start' END")
_D_STATE = "CASE length(text) % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'blank' WHEN 2 THEN 'ruling' ELSE '' END"
_D_SCOPE = "CASE conv_id % 3 WHEN 0 THEN 'line' WHEN 1 THEN 'space' ELSE '' END"

_N3_SQL = f"""
WITH d AS (SELECT conv_id, turn, {_D_TYPE} AS type, {_D_STATE} AS state, {_D_SCOPE} AS scope FROM conversations)
SELECT conv_id, turn, CASE
  WHEN type = 'object' THEN NULL
  WHEN type = 'line-start' THEN chr(10)
  WHEN type = 'column' THEN chr(10) || '#COLUMN#' || chr(10)
  WHEN type = 'surface' THEN '#SURFACE#'
  WHEN state = 'missing' THEN chr(10) || '#MISSING#' || chr(10)
  WHEN state = 'blank' AND scope = 'line' THEN chr(10) || '#MISSING#' || chr(10)
  WHEN state = 'blank' AND scope = 'space' THEN chr(10) || '#BLANK_SPACE#' || chr(10)
  WHEN state = 'ruling' THEN chr(10) || '#RULING#' || chr(10)
END AS tok FROM d
"""


@register("discontinuity_tokens", _N3_SQL, "N3")
def discontinuity_tokens(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    node = F.struct(F.expr(_D_TYPE).alias("type"), F.expr(_D_STATE).alias("state"), F.expr(_D_SCOPE).alias("scope"))
    return conv.select("conv_id", "turn", discontinuity_token(node).alias("tok"))


# ---- N6: bracket repair on words of documents -----------------------------
# text: the word with brackets placed by its length; ideal: by its letters
_N6_TEXT = ("CASE length(w) % 5 WHEN 0 THEN w WHEN 1 THEN '[' || w WHEN 2 THEN w || ']' "
            "WHEN 3 THEN substr(w, 1, 2) || '[' || substr(w, 3) ELSE substr(w, 1, 1) || ']' || substr(w, 2) END")
_N6_IDEAL = ("CASE ascii(w) % 7 WHEN 0 THEN '' WHEN 1 THEN '[]' WHEN 2 THEN '[' WHEN 3 THEN ']' "
             "WHEN 4 THEN '][' WHEN 5 THEN '[][]' ELSE ']]' END")
_WORDS_SQL = ("SELECT DISTINCT w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) "
              "WHERE w <> ''")


def _sql_brackets(x: str) -> str:
    return f"regexp_replace({x}, '[^\\[\\]]', '', 'g')"


def _sql_unbracket(x: str) -> str:
    return f"replace(replace({x}, '[', ''), ']', '')"


def _repair_ctes(src: str) -> str:
    """CTEs over ``src(t, ideal, ...)`` ending in ``rep`` with ``repaired``."""
    return f"""
b AS (SELECT *, {_sql_brackets('t')} AS actual FROM {src}),
c AS (SELECT *,
  CASE WHEN actual LIKE '[%' THEN t ELSE '[' || t END AS r2a FROM b),
d AS (SELECT *, CASE WHEN actual LIKE '%]' THEN r2a ELSE r2a || ']' END AS r2b FROM c),
e AS (SELECT *,
  CASE WHEN {_sql_brackets('r2b')} = ideal THEN r2b ELSE '[' || {_sql_unbracket('t')} || ']' END AS r2,
  CASE WHEN ideal LIKE ']%' AND actual NOT LIKE ']%' THEN
    CASE WHEN strpos(t, '[') = 0 THEN t || ']' ELSE substr(t, 1, strpos(t, '[') - 1) || ']' || substr(t, strpos(t, '[')) END
  ELSE t END AS r3 FROM d),
f AS (SELECT *,
  CASE WHEN ideal LIKE '%[' AND actual NOT LIKE '%[' THEN
    CASE WHEN strpos(r3, ']') = 0 THEN '[' || r3 ELSE substr(r3, 1, strpos(r3, ']') - 1) || '[' || substr(r3, strpos(r3, ']')) END
  ELSE r3 END AS r4 FROM e),
g AS (SELECT *, {_sql_unbracket('r4')} AS fb0 FROM f),
h AS (SELECT *, CASE WHEN contains(ideal, '[]') THEN '[' || fb0 || ']' ELSE fb0 END AS fb1 FROM g),
i AS (SELECT *, CASE WHEN ideal LIKE '[%' THEN '[' || fb1 ELSE fb1 END AS fb2 FROM h),
j AS (SELECT *, CASE WHEN ideal LIKE '%]' THEN fb2 || ']' ELSE fb2 END AS fb3 FROM i),
rep AS (SELECT *, CASE
  WHEN ideal = '' THEN t
  WHEN ideal = actual THEN t
  WHEN ideal LIKE '[%' AND ideal LIKE '%]' THEN r2
  WHEN {_sql_brackets('r4')} = ideal THEN r4
  ELSE fb3 END AS repaired FROM j)"""


_N6_SQL = f"""
WITH words AS ({_WORDS_SQL}),
a AS (SELECT w, {_N6_TEXT} AS t, {_N6_IDEAL} AS ideal FROM words),
{_repair_ctes('a').strip()}
SELECT w, t AS text, ideal, repaired FROM rep
"""


@register("repair_brackets", _N6_SQL, "N6")
def repair_brackets_q(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = docs.select(F.explode(F.split("text", " ", -1)).alias("w")).filter(F.col("w") != "").distinct()
    x = words.select("w", F.expr(_N6_TEXT).alias("text"),
                     F.expr(_N6_IDEAL).alias("ideal"))
    return x.select("w", "text", "ideal", repair_brackets(F.col("text"), F.col("ideal")).alias("repaired"))


register("assemble_text", _assemble_sql(), "N4 N5 N6 N7 N8 N9 N10")(assemble_text_q)


# ---- S3 S5: faults planted in trees, one kind per conversation ------------
_FAULTS = [  # (what a conversation's text becomes, scope, reason), by conv_id % 8
    ("substring(json, 1, length(json) - 1)", "text", "malformed JSON"),
    ("replace(json, '{\"cdl\":[{\"node\":\"c\",\"type\":\"text\"', '{\"CDL\":[{\"node\":\"c\",\"type\":\"text\"')", "text", "no node list"),
    ("replace(json, '\"type\":\"line-start\"', '\"type\":\"line-begin\"')", "tree", "value outside domain: type"),
    ("replace(json, '\"inst\":\"i\"', '\"inst\":\"i\",\"extra\":1')", "tree", "unknown field extra"),
    ("replace(json, '\"type\":\"discourse\",\"id\":\"t\"', '\"type\":\"discourse\"')", "tree", "missing field id"),
    ("replace(json, '\"ref\":\"r\"', '\"ref\":7')", "tree", "wrong type of ref"),
    ("replace(json, '\"node\":\"l\"', '\"node\":\"z\"')", "tree", "unknown node kind"),
]
_VALIDATE_SQL = "SELECT DISTINCT conv_id AS id, CASE conv_id % 8 " + " ".join(
    f"WHEN {i} THEN '{scope}'" for i, (_, scope, _r) in enumerate(_FAULTS)) + " ELSE 'ok' END AS scope, CASE conv_id % 8 " + " ".join(
    f"WHEN {i} THEN '{reason}'" for i, (_, _s, reason) in enumerate(_FAULTS)) + " ELSE '' END AS reason FROM conversations"


@register("validate_nodes", _VALIDATE_SQL, "S3 S5")
def validate_nodes(spark, sf_dir):
    trees = conversation_trees(spark, sf_dir)
    fault = F.col("json")
    for i, (change, _, _r) in enumerate(_FAULTS):
        fault = F.when(F.col("id") % 8 == i, F.expr(change)).otherwise(fault)
    texts = materialize(trees.select("id", fault.alias("json")))
    rejects = tree_rejects(texts, flatten_tree(texts))
    good = texts.select("id").join(rejects.select("id"), "id", "left_anti")
    return rejects.unionByName(good.select("id", F.lit("ok").alias("scope"), F.lit("").alias("reason")))
