"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next stage's docs:

1. toxicity: documents that the CRF scores 0.5 or more go;
2. near_duplicates: of each component of the n-gram Jaccard join one document
   stays, the one with the least doc_id; documents without words all stay. Texts
   are linked when their runs of five words have a similarity of 0.8 or more (the
   op9 query has settings of its own, four words and 0.85);
3. secrets: findings in the texts give way to a mark, ``n_chars`` is counted anew;
4. mixing: every document comes as often as the mix takes it;
5. bpe: one row per remaining document with its token ids.

All but the last return the columns of documents. Rows that share a doc_id are
told apart by their texts; equal rows of one component are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribal.llm import bpe, mixing, ngram_join, secrets, toxicity
from scribal.llm.common import importable, table, written
from scribal.llm.queries import bpe_path


#: Words of a run and percent of similarity from which near_duplicates links texts.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels are learned from the given tables, all of docs are scored."""
    importable(spark)
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that names its component stays, the others go."""
    importable(spark)
    return ngram_join.keep_one(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return mixing.emit(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return bpe.encode(docs, bpe_path()).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: SQL cannot express the trained and the entropy stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder; what is
    written there goes when the driver's session ends."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
