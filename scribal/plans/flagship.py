"""The flagship query used by the driver's smoke check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribal.operators.clean import clean
from scribal.operators.collate import apply_filters, keep_first, union_common
from scribal.plans.fixtures import marked
from scribal.plans.q_collate import _corpora


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as three corpora -> common-column union -> keep the first
    copy of each text -> markup injected -> full cleaning chain (K1-K30)
    -> texts and tokens per language."""
    docs = apply_filters(union_common(_corpora(spark, sf_dir)), [F.col("transliteration") != ""])
    firsts = keep_first(docs, ["transliteration"])
    texts = firsts.select("id", F.col("language").alias("lang"), marked(F.col("transliteration"), F.col("id")).alias("t"))
    cleaned = clean(texts, text_col="t", id_col="id", out_col="t")
    tokens = F.size(F.filter(F.split(F.col("t"), "[ \n]+"), lambda w: w != ""))
    return cleaned.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_texts"), F.sum(tokens).cast("bigint").alias("n_tokens")
    )
