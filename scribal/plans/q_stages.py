"""Driver queries for the readers of sign lists and rule files (S9, S11) and for
the run's records (S7, T4).

The files are written by Spark from the driver tables and read back by the
library's readers, so their size follows the tables'.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from scribal.functions import rule_values as V
from scribal.operators.collate import standardise, with_ord
from scribal.operators.lookups import glyph_pairs, reading_pairs
from scribal.plans import manifest as M
from scribal.plans import stages as P
from scribal.plans.fixtures import table
from scribal.plans.q_collate import _PART, LANG_RULES, _nested_case
from scribal.plans.q_lookups import VOCAB_SQL, override_rows, sign_rows, vocabulary
from scribal.plans.registry import register
from scribal.session import materialize, scratch_path
from scribal.sources.rules import load_pairs
from scribal.sources.signs import read_reading_index, read_sign_list


def _body(b: Column) -> list[Column]:
    def named(values: Column, field: str) -> Column:
        return F.transform(values, lambda v: F.struct(F.struct(v.alias("n")).alias(field)))

    return [b["n"].alias("n"), b["ucun"].alias("sl:ucun"), named(b["aka"], "sl:aka").alias("j:aka"), named(b["values"], "sl:v").alias("j:values")]


def _document(sign: Column) -> Column:
    """A sign list of one sign, in the dictionary's nested form."""
    forms = F.transform(sign["forms"], lambda f: F.struct(F.struct(*_body(f)).alias("sl:form")))
    one = F.struct(F.struct(*_body(sign), forms.alias("j:forms")).alias("sl:sign"))
    letter = F.struct(F.struct(F.array(one).alias("j:signs")).alias("sl:letter"))
    return F.to_json(F.struct(F.struct(F.array(letter).alias("j:letters")).alias("sl:signlist")))


@register(
    "sign_list_scan",
    f"""WITH {VOCAB_SQL}
SELECT 'glyph' AS kind, glyph_name AS name, glyph AS value, count(*) AS n FROM gpairs GROUP BY ALL
UNION ALL SELECT 'reading', glyph_name, reading, count(*) FROM rpairs GROUP BY ALL
UNION ALL SELECT 'override', glyph_name, reading, count(*) FROM ov GROUP BY ALL""",
    "S9",
)
def sign_list_scan(spark, sf_dir):
    """The vocabulary's sign list and override list, written as JSON documents, one
    a line, and scanned."""
    vocab = materialize(vocabulary(spark, sf_dir))
    path = scratch_path(spark)
    sign_rows(vocab).select(_document(F.col("sign")).alias("value")).write.text(f"{path}/signs")
    override_rows(vocab).select(F.to_json(F.struct(F.create_map("reading", "glyph_name").alias("index"))).alias("value")).write.text(f"{path}/index")
    signs = materialize(read_sign_list(spark, f"{path}/signs", lines=True))
    index = read_reading_index(spark, f"{path}/index", lines=True)
    pairs = [
        glyph_pairs(signs).select(F.lit("glyph").alias("kind"), F.col("glyph_name").alias("name"), F.col("glyph").alias("value")),
        reading_pairs(signs).select(F.lit("reading"), "glyph_name", "reading"),
        index.select(F.lit("override"), "glyph_name", "reading"),
    ]
    return pairs[0].union(pairs[1]).union(pairs[2]).groupBy("kind", "name", "value").agg(F.count(F.lit(1)).alias("n"))


@register("rule_file_scan", f"SELECT doc_id, {_nested_case('lang', LANG_RULES)} AS lang FROM documents", "S11")
def rule_file_scan(spark, sf_dir):
    """Rules read from a file are applied in the file's order."""
    path = scratch_path(spark)
    spark.createDataFrame([(json.dumps(LANG_RULES),)], "value string").coalesce(1).write.text(path)
    return standardise(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", load_pairs(spark, path))


_LANDED = ["admin_ed12", "royal", "varia"]
_LANGUAGE = "CASE WHEN lang = 'de' THEN 'Klingon' ELSE 'Sumerian' END"
_TEXT = "CASE WHEN doc_id % 17 = 0 THEN '' ELSE text END"


@register(
    "stage_metrics",
    f"""WITH t AS (SELECT ['admin_ed12', 'royal', 'varia'][{_PART} + 1] AS corpus, lower(lang) || CAST(doc_id % 500 AS VARCHAR) AS id,
    {_LANGUAGE} AS language, {_TEXT} AS x FROM documents)
SELECT 'ingest' AS stage, corpus AS part, 'texts' AS "table", count(*) AS n_rows, count(*) FILTER (WHERE x = '') AS n_empty FROM t GROUP BY corpus
UNION ALL SELECT 'collate', 'all', 'collated', count(DISTINCT id), 0 FROM t
WHERE language IN ({', '.join(f"'{x}'" for x in V.KEPT_LANGUAGES)}) AND x <> ''""",
    "S7 T4",
)
def stage_metrics(spark, sf_dir):
    """Rows and empty texts that were observed while the first stages wrote."""
    out = scratch_path(spark)
    docs = table(spark, sf_dir, "documents").withColumn("corpus", F.element_at(F.array(*map(F.lit, _LANDED)), F.expr(f"{_PART} + 1")))
    texts = with_ord(docs, 0, "doc_id").select(
        "corpus", "ord", F.concat(F.lower("lang"), (F.col("doc_id") % 500).cast("string")).alias("id"),
        F.expr(_TEXT).alias("transliteration"), F.expr(_LANGUAGE).alias("language"), F.lit("").alias("langs"),
        F.col("source").alias("period"), F.lit("Letter").alias("genre"))
    for corpus in _LANDED:
        written = P.write_stage(texts.filter(F.col("corpus") == corpus), out, "texts", ["corpus"], "transliteration")
        M.write_record(spark, out, M.Record("ingest", corpus, M.digest(corpus), {"texts": written}))
    M.write_record(spark, out, M.Record("collate", M.WHOLE, M.digest(), P.stage_collate(spark, out, corpora=_LANDED)))
    return M.stage_metrics(spark, out)
