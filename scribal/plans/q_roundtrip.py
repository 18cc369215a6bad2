"""Driver queries that write tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from scribal.operators.lookups import glyph_pairs, multi_codepoint_report
from scribal.operators.reconcile import union_splits
from scribal.operators.split import split_stratified
from scribal.plans.fixtures import table
from scribal.plans.q_lookups import VOCAB_SQL, _names_out, _sql_names_out, build_lookups, sign_rows, vocabulary
from scribal.plans.q_split_reconcile import _SPLIT_SQL, _labelled_docs
from scribal.plans.registry import register
from scribal.plans.stages import export_csv, import_csv, read_stage, write_stage
from scribal.session import scratch_path


@register("csv_round_trip", "SELECT doc_id, md5(text) AS text_md5, coalesce(lang, '') AS lang FROM documents", "S8")
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark)
    export_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    back = import_csv(spark, path, "doc_id long, text string, lang string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@register("lookups_round_trip", f"WITH {VOCAB_SQL}\n{_sql_names_out('reading', 'names', 'rmerged')}", "S10")
def lookups_round_trip(spark, sf_dir):
    path = scratch_path(spark)
    readings, _ = build_lookups(spark, sf_dir)
    write_stage(readings, path, "readings")
    return _names_out(read_stage(spark, path, "readings"), "reading", "names")


@register("splits_round_trip", _SPLIT_SQL, "S12 V7")
def splits_round_trip(spark, sf_dir):
    """One table per split is written; their union is the whole again."""
    path = scratch_path(spark)
    out = split_stratified(_labelled_docs(spark, sf_dir), "lang", "doc_id", route_to_train=F.col("quality") == 0, seed=42)
    write_stage(out.select("doc_id", "lang", "split"), path, "splits", ["split"])
    splits = [spark.read.schema("doc_id long, lang string").parquet(f"{path}/splits/split={name}").withColumn("split", F.lit(name))
              for name in ("train", "validation", "test")]
    return union_splits(splits)


@register(
    "lookup_multi_codepoint",
    f"""WITH {VOCAB_SQL}
SELECT glyph_name, CAST(count(DISTINCT glyph) FILTER (WHERE glyph <> '') AS INT) AS n_candidates
FROM gpairs GROUP BY glyph_name HAVING count(DISTINCT glyph) FILTER (WHERE glyph <> '') > 1""",
    "L7",
)
def lookup_multi_codepoint(spark, sf_dir):
    pairs = glyph_pairs(sign_rows(vocabulary(spark, sf_dir)))
    return multi_codepoint_report(pairs).select("glyph_name", "n_candidates")
