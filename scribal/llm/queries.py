"""The driver's queries of the training-data operators and their DuckDB SQL.

Each ``opN_<name>`` applies its operator to the whole intended table and
derives the contract's digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribal.llm import bpe, html_text, lexical_search, minhash, mixing, ngram_join, quality_classifier, quality_rules, runs, secrets, simhash, span_dedup, toxicity
from scribal.llm.common import bind, importable, table, words, written
from scribal.llm.labelled import held_out
from scribal.llm.oracles import LEXICAL_SEARCH_SQL, MINHASH_SQL, MIXING_SQL, NGRAM_JOIN_SQL, QUALITY_RULES_SQL

#: The file of a public tokenizer is found by this name; its path is a parameter of the operator.
BPE_FILE = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(importable(spark), sf_dir)
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


@_query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def _predicted(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


@_query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _predicted(toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))), 0.5)


@_query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _predicted(quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels"))), 0.3)


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BPE_FILE)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of the ids and of the text they decode to."""
    encoded = bpe.decode(bpe.encode(docs, bpe_path()), bpe_path())
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@_query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


@_query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@_query("op5_quality_rules", QUALITY_RULES_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query("op7_mixing", MIXING_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents; for those whose id is divisible by 20
    also how many other documents' fingerprints lie within the radius."""
    marked = written(simhash.fingerprint_documents(table(spark, sf_dir, "documents")))
    near = simhash.within_radius(marked.where("doc_id % 20 = 0").select("hi", "lo"), marked.select("hi", "lo"))
    held = F.aggregate("near", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    counts = near.groupBy("q_hi", "q_lo").agg((F.sum(held) - 1).alias("_n"))  # without the document itself
    joined = marked.join(counts, (marked.hi == counts.q_hi) & (marked.lo == counts.q_lo), "left")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.when(F.col("doc_id") % 20 == 0, F.coalesce("_n", F.lit(0))).alias("n_near"))


@_query("op9_ngram_join", NGRAM_JOIN_SQL)
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_ngrams(table(spark, sf_dir, "documents"))


@_query("op10_span_dedup")
def op10_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.remove_repeats(docs)


def periodic_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the texts of a tenth of the documents, by their key's
    checksum, repeat a stretch of theirs from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(w):
        def of(n):
            a = F.expr("g") % n
            p = F.floor((n - a) / (F.lit(3) + F.col("g") % 8)) + 1
            return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
                w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

        return F.when(F.size(w) > 0, bind(F.size(w).cast("long"), of)).otherwise(F.col("text"))

    hashed = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    return hashed.select("doc_id", F.when(F.col("h") % 10 == 0, bind(words(F.col("text")), repeated)).otherwise(F.col("text")).alias("text"))


@_query("op11_runs")
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(periodic_texts(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.floor(F.expr("1000 * best.length div -best.short")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@_query("op12_minhash", MINHASH_SQL)
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op13_lexical_search", LEXICAL_SEARCH_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
