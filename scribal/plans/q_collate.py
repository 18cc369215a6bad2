"""Driver queries for collation."""

from __future__ import annotations

from pyspark.sql import functions as F

from scribal.operators.collate import (
    ORD,
    apply_filters,
    collapse_values,
    keep_first,
    order_parts,
    standardise,
    union_common,
    with_ord,
)
from scribal.operators.key_index import KeepFirstStore
from scribal.plans.fixtures import table
from scribal.plans.registry import register
from scribal.session import scratch_path

# documents split into three "corpora" with differing column sets
_PART = "CAST(substr(source, 4) AS INT) % 3"


def _corpora(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("_part", F.expr(_PART))
    base = [
        F.col("doc_id").alias("id"),
        F.col("text").alias("transliteration"),
        F.col("lang").alias("language"),
        "source",
    ]
    t0 = docs.filter("_part = 0").select(*base, "n_chars", "doc_id")
    t1 = docs.filter("_part = 1").select(*base, F.lit("b").alias("note"), "doc_id")
    t2 = docs.filter("_part = 2").select(*base, "n_chars", "doc_id")
    return [with_ord(t, i, "doc_id").drop("doc_id") for i, t in enumerate([t0, t1, t2])]


def _filters():
    return [
        F.col("language").isin("en", "fr", "de", ""),
        ~F.coalesce(F.col("transliteration").contains("icense"), F.lit(False)),
        F.col("source") != F.lit("src5"),
        F.col("transliteration") != F.lit(""),
    ]


def _flat(df):
    rank, pos = order_parts(F.col(ORD))
    return df.select(*[c for c in df.columns if c != ORD], rank.alias("corpus_rank"), pos.alias("pos"))


_UNION_SQL = f"""
WITH u AS (
  SELECT doc_id AS id, text AS transliteration, lang AS language, source, 0 AS corpus_rank, doc_id AS pos
  FROM documents WHERE {_PART} = 0
  UNION ALL
  SELECT doc_id, text, lang, source, 1, doc_id FROM documents WHERE {_PART} = 1
  UNION ALL
  SELECT doc_id, text, lang, source, 2, doc_id FROM documents WHERE {_PART} = 2
), f AS (
  SELECT * FROM u
  WHERE language IN ('en', 'fr', 'de', '')
    AND NOT coalesce(contains(transliteration, 'icense'), false)
    AND source <> 'src5' AND transliteration <> ''
)
"""


@register("collate_union_common", _UNION_SQL + "SELECT * FROM f", "C1 C2 C3 C4 C5")
def collate_union_common(spark, sf_dir):
    return _flat(apply_filters(union_common(_corpora(spark, sf_dir)), _filters()))


@register(
    "collate_keep_first",
    _UNION_SQL
    + """SELECT id, md5(transliteration) AS text_md5, language, source, corpus_rank, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY transliteration ORDER BY corpus_rank, pos) AS rn FROM f
) WHERE rn = 1""",
    "C6",
)
def collate_keep_first(spark, sf_dir):
    df = apply_filters(union_common(_corpora(spark, sf_dir)), _filters())
    first = _flat(keep_first(df, ["transliteration"]))
    return first.select("id", F.md5("transliteration").alias("text_md5"), "language", "source", "corpus_rank", "pos")


_KEEP_FIRST_SQL = _UNION_SQL + """SELECT id, md5(transliteration) AS text_md5, language, source, corpus_rank, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY transliteration ORDER BY corpus_rank, pos) AS rn FROM f
) WHERE rn = 1"""


@register("collate_landings", _KEEP_FIRST_SQL, "C6")
def collate_landings(spark, sf_dir):
    """The corpora land one by one, the last in union order first; the rows that
    stay are those of one keep-first."""
    store = KeepFirstStore(spark, scratch_path(spark), ["transliteration"])
    common = union_common(_corpora(spark, sf_dir)).columns
    for rank, corpus in reversed(list(enumerate(_corpora(spark, sf_dir)))):
        store.land(apply_filters(corpus.select(*common), _filters()), f"corpus-{rank}")
    first = _flat(store.rows())
    return first.select("id", F.md5("transliteration").alias("text_md5"), "language", "source", "corpus_rank", "pos")


# ordered raw -> canonical pairs; 'en' reaches 'Anglais' through 'English'
LANG_RULES = [("en", "English"), ("fr", "French"), ("English", "Anglais"), ("de", "German"), ("", "Unknown")]


def _nested_case(col: str, pairs) -> str:
    expr = col
    for raw, canonical in pairs:
        expr = f"CASE WHEN {expr} = '{raw}' THEN '{canonical}' ELSE {expr} END"
    return expr


@register(
    "collate_standardise",
    f"""SELECT doc_id AS id,
       CASE WHEN source IN ('src0', 'src1') THEN 'Unknown' ELSE source END AS period,
       {_nested_case('lang', LANG_RULES)} AS genre
FROM documents""",
    "C7 C8 C9",
)
def collate_standardise(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("period"), F.col("lang").alias("genre")
    )
    docs = docs.withColumn("period", collapse_values(F.col("period"), ["src0", "src1"], "Unknown"))
    return standardise(docs, "genre", LANG_RULES)
