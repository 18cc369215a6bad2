"""Derive rule-exercising inputs from the driver's test tables.

The test tables hold plain prose, so markup is injected by ordered
literal word -> template replacements (``marked``). Both engines apply the
same literal replacements, so Spark and the SQL oracle see equal inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scribal.functions import rule_values as V
from scribal.functions.text import literal_fold
from scribal.sources.tables import input_partitions, spread

# ---------------------------------------------------------------------------
# FIXED VALUES: markup injected into prose, applied in this order.
# ---------------------------------------------------------------------------
MARKUP = [
    (" the ", " [the (x]) x "),
    (" and ", " {[and}ki] n-"),
    (" of ", " ([x) x] "),
    (" in ", " [in{a]} "),
    (" is ", " <is{b>} {{gl}} "),
    (" that ", " {<that}> (x) "),
    (" for ", " (for) (or) "),
    (" on ", " |A.B|on ⸢du⸣ "),
    (" are ", " <<are>> ... "),
    (" with ", " <with "),
    (" to ", " [to; to] "),
    (" as ", " $AN {-as-} "),
    (" de ", " [de] x "),
    (" la ", " <la> -n- "),
    (" die ", " {die}-(die) "),
    (" und ", " (und) {{und}} "),
    (" le ", " [le "),
    (" el ", " el; [el] "),
]

# Every search string of the rule tables, in words, one per document in turn:
# sign-list strings alone and inside words, numbers as words and before a
# hyphen, dollar literals, in-band tokens.
ADDITIONS = [
    *[f" {old} qa-{old} ku{old} " for old, _ in V.SIGN_LIST_REPLACEMENTS],
    *[f" {old} {old}-ta " for old, _ in V.READING_FIXES],
    *[f" qa {old} ku " for old in V.DOLLAR_LITERALS],
    *[f" qa {old} ku " for old in ("#MISSING#", "#SURFACE#", "#COLUMN#", "#BLANK_SPACE#", "#RULING#", "#note#")],
]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, dealt anew when the session's setting says so."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), input_partitions(spark))


def marked(text: Column, doc_id: Column) -> Column:
    added = F.element_at(F.array(*[F.lit(a) for a in ADDITIONS]), (doc_id % len(ADDITIONS) + 1).cast("int"))
    return F.concat(literal_fold(text, MARKUP), added)


def marked_sql(text: str = "text", doc_id: str = "doc_id") -> str:
    """The same for the SQL oracle."""
    from scribal.plans.oracle_sql import fold_sql, q

    return f"({fold_sql(text, MARKUP)} || [{', '.join(map(q, ADDITIONS))}][{doc_id} % {len(ADDITIONS)} + 1])"


def marked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, source, lang, t)`` with markup injected into the text."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "source", "lang", marked(F.col("text"), F.col("doc_id")).alias("t"))
