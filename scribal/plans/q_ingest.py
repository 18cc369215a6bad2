"""Driver queries for catalogue ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from scribal.sources.catalogue import catalogue_from_text, conform_catalogue, text_id_expr
from scribal.plans.fixtures import table
from scribal.plans.registry import register

# catalogue rows derived from documents: ids present or blank by position,
# the model kind chosen by source
_ID_TEXT = "CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'P' || CAST(doc_id AS VARCHAR) END"
_ID_COMP = "CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Q' || CAST(doc_id AS VARCHAR) END"
_KINDS = ["base", "early_literary", "oldbab_literary", "royal"]
_KIND = "CASE CAST(substr(source, 4) AS INT) % 4 " + " ".join(
    f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END"

_S4_SQL = f"""
WITH c AS (SELECT doc_id, {_KIND} AS kind, {_ID_TEXT} AS id_text, {_ID_COMP} AS id_composite FROM documents)
SELECT doc_id, kind, CASE
  WHEN kind IN ('early_literary', 'oldbab_literary') THEN CASE WHEN id_composite = '' THEN id_text ELSE id_composite END
  WHEN kind = 'royal' THEN CASE WHEN id_text = '' THEN id_composite ELSE id_text END
  ELSE id_text END AS text_id
FROM c
"""


@register("resolve_text_id", _S4_SQL, "S4")
def resolve_text_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    c = docs.select(
        "doc_id",
        F.expr(_KIND.replace("VARCHAR", "STRING")).alias("kind"),
        F.expr(_ID_TEXT.replace("VARCHAR", "STRING")).alias("id_text"),
        F.expr(_ID_COMP.replace("VARCHAR", "STRING")).alias("id_composite"),
    )
    expr = F.lit(None).cast("string")
    for k in _KINDS:
        expr = F.when(F.col("kind") == k, text_id_expr(k, F.col("id_text"), F.col("id_composite"))).otherwise(expr)
    return c.select("doc_id", "kind", expr.alias("text_id"))


_E = "CAST([] AS VARCHAR[])"
_S5_SQL = f"""
WITH p AS (
  SELECT doc_id, list_concat(list_concat(
      CASE WHEN n_chars % 9 = 0 THEN ['unknown field xyz'] ELSE {_E} END,
      CASE WHEN n_chars % 11 = 0 THEN ['missing field project'] ELSE {_E} END),
      CASE WHEN lang = 'de' THEN ['value outside domain: language'] ELSE {_E} END) AS probs
  FROM documents
)
SELECT 'test' AS corpus, 'P' || CAST(doc_id AS VARCHAR) AS id,
       CASE WHEN len(probs) = 0 THEN 'ok' ELSE 'catalogue' END AS scope, array_to_string(probs, '; ') AS reason
FROM p
"""


@register("validate_schema", _S5_SQL, "S2 S5 S6")
def validate_schema(spark, sf_dir):
    """One single-member catalogue per document; some members carry an
    unknown field, lack a required field, or hold an out-of-domain value."""
    docs = table(spark, sf_dir, "documents")
    lang = (F.when(F.col("lang") == "en", F.lit("Sumerian")).when(F.col("lang") == "fr", F.lit("Akkadian"))
            .when(F.col("lang") == "de", F.lit("Klingon")).otherwise(F.lit("")))
    member = F.create_map(
        F.lit("id_text"), F.concat(F.lit("P"), F.col("doc_id").cast("string")),
        F.lit("provenience"), F.col("source"),
        F.lit("language"), lang,
        F.lit("period"), F.lit("Ur III"),
    )
    member = F.when(F.col("n_chars") % 11 != 0, F.map_concat(member, F.create_map(F.lit("project"), F.lit("p")))).otherwise(member)
    member = F.when(F.col("n_chars") % 9 == 0, F.map_concat(member, F.create_map(F.lit("xyz"), F.lit("1")))).otherwise(member)
    raw = docs.select(F.to_json(F.struct(F.create_map(F.col("doc_id").cast("string"), member).alias("members"))).alias("value"))
    good, rejects = conform_catalogue(catalogue_from_text(raw), "test", "base", 0)
    return good.select("corpus", "id", F.lit("ok").alias("scope"), F.lit("").alias("reason")).unionByName(rejects)
