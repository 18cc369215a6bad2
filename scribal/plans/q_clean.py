"""Driver queries for the cleaning stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from scribal.functions import rule_values as V
from scribal.operators import clean as C
from scribal.operators.quality import bracket_balance
from scribal.operators.rulechain import apply_chain
from scribal.plans.fixtures import marked_documents, marked_sql, table
from scribal.plans.oracle_sql import chain_sql, fold_sql, q, with_query
from scribal.plans.registry import register

MARKED_SQL = f"SELECT doc_id, {marked_sql()} AS t FROM documents"

# Test patches keyed on driver document ids (the production patches are
# keyed on corpus ids that do not occur in the test tables).
TEST_PATCHES = [
    ("3", "xon", " #MISSING# ", " ~ "),
    ("7", "xon", "e", "E"),
    ("11", "before_enclosures", "[", "[["),
]

LITERAL_FOLDS = (
    C.Step("K1", "fold", pairs=tuple(V.DOUBLE_ANGLE)),
    C.Step("K2", "fold", pairs=tuple(V.HALF_BRACKETS)),
    *C.SEMICOLONS,
    *C.CURLY,
    *C.DOLLARS,
    *C.ELLIPSES,
    *C.EMPTY_ENCLOSURES,
    *C.PUBLISH,
)


def _chain_query(name: str, chain, operators: str, patches=()):
    ctes, last = chain_sql(MARKED_SQL, chain, "t", "doc_id", patches)
    sql = with_query(ctes, f"SELECT doc_id, t AS text FROM {last}")

    @register(name, sql, operators)
    def build(spark, sf_dir):
        df = marked_documents(spark, sf_dir).select("doc_id", "t")
        out = apply_chain(df, "t", chain, id_col="doc_id", patches=patches)
        return out.select("doc_id", F.col("t").alias("text"))

    return build


_chain_query("clean_literal_folds", LITERAL_FOLDS, "K1 K2 K14 K15 K21 K22 K27 K29")
_chain_query("clean_glosses", C.GLOSSES, "K3")
_chain_query("clean_collapse", C.COLLAPSE, "K4")
_chain_query("clean_enclosure_order", C.ENCLOSURE_ORDER, "K7-K12")
_chain_query("clean_angle", C.ANGLE, "K13")
_chain_query("clean_square", C.SQUARE, "K19")
_chain_query("clean_parens", C.PARENS_HYPHEN + C.STANDALONE_PARENS + C.MISSING_ALONE, "K17 K24 K26")
_chain_query("clean_bars", C.BARS, "K16")
_chain_query("clean_missing_marks", C.MISSING_MARKS, "K20 K23", patches=TEST_PATCHES)
_chain_query("clean_chain", C.CHAIN, "K1-K29", patches=TEST_PATCHES)

# The full chain, then drop rows holding only tokens.
_ctes, _last = chain_sql(MARKED_SQL, C.CHAIN, "t", "doc_id", TEST_PATCHES)
_residue = fold_sql("t", [(tok, "") for tok in V.PUBLISHED_TOKENS])


@register(
    "clean_drop_empty",
    with_query(_ctes, f"SELECT doc_id, t AS text FROM {_last} WHERE {_residue} <> ''"),
    "K1-K30",
)
def clean_drop_empty(spark, sf_dir):
    df = marked_documents(spark, sf_dir).select("doc_id", "t")
    out = C.clean(df, text_col="t", id_col="doc_id", out_col="t", patches=TEST_PATCHES)
    return out.select("doc_id", F.col("t").alias("text"))


# Q1: every check hit, at the point of the chain where it is taken.
_vctes, _vlast = chain_sql(MARKED_SQL, C.CHAIN, "t", "doc_id", TEST_PATCHES, report=True, prefix="v")


@register(
    "quality_violations",
    with_query(
        _vctes,
        f"SELECT doc_id, c.stage AS stage, c.rule AS rule FROM (SELECT doc_id, unnest(checks) AS c FROM {_vlast})",
    ),
    "Q1 K5 K18 K25 K28",
)
def quality_violations(spark, sf_dir):
    df = marked_documents(spark, sf_dir).select("doc_id", "t")
    out = C.clean(df, text_col="t", id_col="doc_id", out_col="t", patches=TEST_PATCHES,
                  report=True, filter_empty=False)
    return C.violations(out, "doc_id")


# Q2: unbalanced square brackets per line of the marked text.
_BAL_SQL = f"""
WITH lines AS (
  SELECT doc_id, u.line, u.ord - 1 AS line_no
  FROM ({MARKED_SQL}) m, unnest(string_split(m.t, chr(10))) WITH ORDINALITY AS u(line, ord)
), br AS (
  SELECT doc_id, line_no, regexp_replace(line, '[^\\[\\]]', '', 'g') AS b FROM lines
), scan AS (
  SELECT doc_id, line_no,
         list_reduce(list_transform(string_split(b, ''), lambda c: CASE WHEN c = '[' THEN 1 ELSE -1 END),
                     lambda acc, d: CASE WHEN acc < 0 THEN acc WHEN acc + d < 0 THEN -1000000 ELSE acc + d END,
                     0) AS depth
  FROM br WHERE b <> ''
)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no FROM scan WHERE depth <> 0
"""


@register("bracket_balance", _BAL_SQL, "Q2 K6")
def bracket_balance_q(spark, sf_dir):
    df = marked_documents(spark, sf_dir).select("doc_id", "t")
    return bracket_balance(df, "t", "doc_id").select("doc_id", "line_no")


__all__ = ["q"]


# the patches of single texts, each on documents that carry its text's id and
# the string that it replaces
_IDS = [p[0] for p in V.TEXT_PATCHES]
_BITS = [f" qa {old}ku " for _, _, old, _ in V.TEXT_PATCHES]
_N = len(_IDS)


_list = lambda values: "[" + ", ".join(q(v) for v in values) + "]"
_pctes, _plast = chain_sql(
    f"SELECT doc_id, {_list(_IDS)}[doc_id % {_N} + 1] AS id, text || {_list(_BITS)}[(doc_id // {_N}) % {_N} + 1] AS t FROM documents",
    C.CHAIN, "t", "id", V.TEXT_PATCHES, prefix="p")


@register("clean_text_patches", with_query(_pctes, f"SELECT doc_id, id, t AS text FROM {_plast}"), "K5 K18 K23 K25 K28")
def clean_text_patches(spark, sf_dir):
    def pick(values, at):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (at % _N + 1).cast("int"))

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", pick(_IDS, F.col("doc_id")).alias("id"),
        F.concat("text", pick(_BITS, F.floor(F.col("doc_id") / _N))).alias("t"))
    out = apply_chain(docs, "t", C.CHAIN, id_col="id", patches=V.TEXT_PATCHES)
    return out.select("doc_id", "id", F.col("t").alias("text"))
