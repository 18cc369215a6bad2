"""Driver queries for the split (P1-P5) and reconciliation (V1-V7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scribal.operators.reconcile import cell_diff, key_diff_of, reconcile, union_splits
from scribal.operators.split import numbered_splits, split_stratified
from scribal.plans.fixtures import table
from scribal.plans.registry import register


def _labelled_docs(spark, sf_dir):
    """Documents with their quality label; one source's language is unknown."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("source") != "src5", F.col("lang")).alias("lang"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")


def _quota_sql(src: str, name: str, n: str, num: int, den: int) -> str:
    return f"""
{name}_0 AS (SELECT *, ({n} * {num}) // {den} AS b, ({n} * {num}) % {den} AS r FROM {src}),
{name} AS (SELECT * EXCLUDE (b, r), b + CASE WHEN row_number() OVER (ORDER BY r DESC, lang NULLS FIRST)
    <= (sum({n}) OVER () * {num} + {den - 1}) // {den} - sum(b) OVER () THEN 1 ELSE 0 END AS {name}_q FROM {name}_0)"""


_SPLIT_SQL = f"""
WITH base AS (
  SELECT d.doc_id, CASE WHEN d.source <> 'src5' THEN d.lang END AS lang, coalesce(l.quality = 0, false) AS routed
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), rest AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) AS rn
  FROM base WHERE NOT routed),
counts AS (SELECT lang, count(*) AS n FROM rest GROUP BY lang),
{_quota_sql('counts', 'tst', 'n', 5, 100)},
remain AS (SELECT *, n - tst_q AS m FROM tst),
{_quota_sql('remain', 'val', 'm', 5, 95)}
SELECT doc_id, lang, 'train' AS split FROM base WHERE routed
UNION ALL
SELECT doc_id, rest.lang, CASE WHEN rn <= tst_q THEN 'test' WHEN rn <= tst_q + val_q THEN 'validation' ELSE 'train' END
FROM rest JOIN val ON rest.lang IS NOT DISTINCT FROM val.lang
"""


@register("split_stratified", _SPLIT_SQL, "P1 P2 P3 P4 P5")
def split_stratified_q(spark, sf_dir):
    docs = _labelled_docs(spark, sf_dir)
    out = split_stratified(docs, "lang", "doc_id", route_to_train=F.col("quality") == 0, seed=42)
    return out.select("doc_id", "lang", "split")


@register(
    "split_ordered",
    f"""SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) AS row_no
FROM ({_SPLIT_SQL})""",
    "P5",
)
def split_ordered(spark, sf_dir):
    """Every split in its seeded order."""
    docs = _labelled_docs(spark, sf_dir)
    out = split_stratified(docs, "lang", "doc_id", route_to_train=F.col("quality") == 0, seed=42)
    return numbered_splits(out.select("doc_id", "split"), "doc_id", seed=42)


# an altered copy of documents: rows of one source dropped, German texts
# edited, one source's language changed, and some rows added
def _versions(spark, sf_dir, files=1):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    whole = union_splits([docs.filter(F.col("doc_id") % files == k) for k in range(files)])  # V7: split files
    bench = table(spark, sf_dir, "benchmark")
    altered = docs.filter(F.col("source") != "src3").select(
        "doc_id",
        F.when(F.col("lang") == "de", F.concat("text", F.lit(" x"))).otherwise(F.col("text")).alias("text"),
        F.when(F.col("source") == "src7", F.upper("lang")).otherwise(F.col("lang")).alias("lang"),
        "source",
    )
    extra = bench.select((F.col("item_id") + 1_000_000).alias("doc_id"), "text", F.lit("en").alias("lang"),
                         F.lit("bench").alias("source"))
    return whole, altered.unionByName(extra)


_VERSIONS_SQL = """
WITH l AS (SELECT doc_id, text, lang, source FROM documents),
r AS (
  SELECT doc_id, CASE WHEN lang = 'de' THEN text || ' x' ELSE text END AS text,
         CASE WHEN source = 'src7' THEN upper(lang) ELSE lang END AS lang, source
  FROM documents WHERE source <> 'src3'
  UNION ALL SELECT item_id + 1000000, text, 'en', 'bench' FROM benchmark
)"""


def _sample_sql(src: str, k: int) -> str:
    return (f"(SELECT coalesce(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id), '') "
            f"FROM (SELECT doc_id FROM {src} ORDER BY doc_id LIMIT {k}))")


@register(
    "reconcile_keys",
    _VERSIONS_SQL + f""", ol AS (SELECT doc_id FROM l ANTI JOIN r USING (doc_id)),
orr AS (SELECT doc_id FROM r ANTI JOIN l USING (doc_id))
SELECT 'only_left' AS side, (SELECT count(*) FROM ol) AS n, {_sample_sql('ol', 10)} AS sample
UNION ALL
SELECT 'only_right', (SELECT count(*) FROM orr), {_sample_sql('orr', 10)}""",
    "V1 V3",
)
def reconcile_keys(spark, sf_dir):
    left, right = _versions(spark, sf_dir)
    return key_diff_of(left, right, "doc_id")


_CELL_COLS = ["text", "lang", "source"]


_EXAMPLES = """array_to_string(list_transform(list_slice(list_sort(list({'k': doc_id, 's': CAST(doc_id AS VARCHAR) || ': ' || substr(lv, 1, 120)
  || ' => ' || substr(rv, 1, 120)})), 1, 3), lambda x: x.s), chr(10))"""


def _cells_sql() -> str:
    parts = []
    for c in _CELL_COLS:
        parts.append(f"SELECT '{c}' AS column_name, doc_id, coalesce(CAST(l.{c} AS VARCHAR), '') AS lv, "
                     f"coalesce(CAST(r.{c} AS VARCHAR), '') AS rv FROM l JOIN r USING (doc_id) "
                     f"WHERE coalesce(CAST(l.{c} AS VARCHAR), '') <> coalesce(CAST(r.{c} AS VARCHAR), '')")
    return " UNION ALL ".join(parts)


@register(
    "reconcile_cells",
    _VERSIONS_SQL + f""", d AS ({_cells_sql()})
SELECT column_name AS "column", count(*) AS n,
       {_EXAMPLES} AS sample
FROM d GROUP BY column_name""",
    "V4 V5",
)
def reconcile_cells(spark, sf_dir):
    left, right = _versions(spark, sf_dir)
    return cell_diff(left, right, "doc_id", _CELL_COLS)


def _fp_sql(src: str) -> str:
    cols = ["CAST(doc_id AS VARCHAR)", "text", "lang", "source"]
    parts = ", ".join(f"coalesce({c}, '')" for c in cols)
    return (f"(SELECT count(*) AS n, CAST(coalesce(sum(CAST(('0x' || substr(sha256(concat_ws(chr(31), {parts})), 1, 15))"
            f" AS BIGINT)::HUGEINT), 0) AS VARCHAR) AS f FROM {src})")


_REPORT_SQL = _VERSIONS_SQL + f""", ol AS (SELECT doc_id FROM l ANTI JOIN r USING (doc_id)),
orr AS (SELECT doc_id FROM r ANTI JOIN l USING (doc_id)),
d AS ({_cells_sql()}),
ls AS (SELECT * FROM l SEMI JOIN r USING (doc_id)), rs AS (SELECT * FROM r SEMI JOIN l USING (doc_id)),
fl AS {_fp_sql('ls')}, fr AS {_fp_sql('rs')}
SELECT 'rows_left' AS "check", CAST(NULL AS VARCHAR) AS "column", count(*) AS n, CAST(NULL AS VARCHAR) AS detail FROM l
UNION ALL SELECT 'rows_right', NULL, count(*), NULL FROM r
UNION ALL SELECT 'columns_only_right', 'note', 1, NULL
UNION ALL SELECT 'only_left', NULL, (SELECT count(*) FROM ol), {_sample_sql('ol', 10)}
UNION ALL SELECT 'only_right', NULL, (SELECT count(*) FROM orr), {_sample_sql('orr', 10)}
UNION ALL SELECT 'duplicate_keys_left', NULL, (SELECT count(*) FROM (SELECT doc_id FROM l GROUP BY doc_id HAVING count(*) > 1)), NULL
UNION ALL SELECT 'duplicate_keys_right', NULL, (SELECT count(*) FROM (SELECT doc_id FROM r GROUP BY doc_id HAVING count(*) > 1)), NULL
UNION ALL SELECT 'cells', column_name, count(*), {_EXAMPLES}
          FROM d GROUP BY column_name
UNION ALL SELECT 'fingerprint_equal', NULL, CASE WHEN fl.n = fr.n AND fl.f = fr.f THEN 1 ELSE 0 END, fl.f || ' vs ' || fr.f
          FROM fl, fr
"""


@register("reconcile_report", _REPORT_SQL, "V1 V2 V3 V4 V5 V6 V7")
def reconcile_report(spark, sf_dir):
    left, right = _versions(spark, sf_dir, files=3)
    return reconcile(left, right.withColumn("note", F.lit("v2")), "doc_id")
