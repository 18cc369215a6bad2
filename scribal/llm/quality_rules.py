"""Quality rules: a threshold table compiled into one Spark projection.

Every figure is an expression over one row (no user function, no shuffle), so
the operator is one narrow pass over the texts whatever their number. Words are
counted by patterns over the whole text. Repeated windows are found inside the row:
each word is hashed once, runs of two, four and eight words by combining two halves;
only texts that repeat a run of four go on to runs of eight, and only those that
repeat one of these pay for sorting (hash, position) pairs.

Defined results: a null text is an empty one; an empty text has no words, all
counts 0 and every ratio 0, so it fails the base rule. Repeated rows get equal
results. Other columns are ignored by ``figures`` and never clash, as only the
key column is carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribal.llm.common import SPACE_CLASS, bind, need, words

WINDOW = 8

# ---------------------------------------------------------------------------
# FIXED VALUES: frequent function words of English, German, French, Spanish.
# ---------------------------------------------------------------------------
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he",
    "this", "are", "or", "his", "from", "at", "which", "but", "have", "an", "had", "they", "you", "were", "a",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht",
    "ein", "eine", "auch", "es", "sind", "dass", "werden", "aus",
    "le", "la", "les", "de", "et", "du", "un", "une", "qui", "pour", "dans", "est", "que", "pas", "sur", "par", "en",
    "au", "avec", "il", "sont", "plus", "ou",
    "el", "y", "los", "se", "las", "por", "para", "con", "no", "su", "al", "lo", "como", "más", "pero", "sus", "del",
]

#: (figure, smallest, largest): a text is kept while every figure lies within.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 20, None),
    ("mean_word_chars", 2.0, 20.0),
    ("symbol_ratio", None, 0.1),
    ("marked_word_ratio", None, 0.3),
    ("capital_word_ratio", None, 0.5),
    ("stop_word_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.5),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
    ("repeat_word_ratio", None, 0.3),
]


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words that lie in some window of ``window`` words found twice or more.

    Windows may overlap; the first occurrence counts as well. Windows are
    compared by 64-bit hashes.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(p: Column) -> Column:
            def twice(e: Column, k: Column) -> Column:
                before = F.when(k > 0, F.get(p, k - 1)["h"] == e["h"]).otherwise(False)
                return before | F.coalesce(F.get(p, k + 1)["h"] == e["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(p, twice), lambda e: e["i"]))

        def total(at: Column) -> Column:
            reach = F.transform(
                at, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - x, F.lit(window))).cast("long"))
            return F.aggregate(reach, F.lit(0).cast("long"), lambda a, b: a + b)

        return bind(bind(pairs, positions), total)

    def doubled(hashes: Column, step: int) -> Column:
        """Hashes of runs twice as long: of each run and the one that follows it."""
        n = F.size(hashes) - step
        return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))

    def twice_as_long(hashes: Column, step: int) -> Column:
        return bind(hashes, lambda h: doubled(h, step))

    def if_repeated(hashes: Column, then) -> Column:
        return bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), then(h)).otherwise(F.lit(0).cast("long")))

    def over(ws: Column) -> Column:
        half = window // 2
        runs, step = F.transform(ws, lambda w: F.xxhash64(w)), 1
        while step < half:
            runs, step = twice_as_long(runs, step), 2 * step
        found = if_repeated(runs, lambda h: if_repeated(doubled(h, half), covered))
        return F.when(F.size(ws) < window + 1, F.lit(0).cast("long")).otherwise(found)

    if window < 2 or window & (window - 1):
        raise ValueError("the window is a power of two")
    return bind(tokens, over)


_S = r"\x20\x09-\x0D"
#: Words that end in symbols, a bar or doubled marks; words in capitals only.
_MARKED = rf"(?:[#*$%&|<>]|[!?]{{2,}})(?=[{_S}]|\z)"
_CAPITAL = rf"(?<![^{_S}])[^\p{{Lu}}\p{{Ll}}{_S}]*+\p{{Lu}}[^\p{{Ll}}{_S}]*+(?=[{_S}]|\z)"


def figures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and all figures that rules may name, one row per document."""
    need(docs, [key, text])
    body = F.coalesce(F.col(text), F.lit(""))
    stops = list(dict.fromkeys(STOP_WORDS))
    base = docs.select(F.col(key), body.alias("_t"), words(F.col(text)).alias("_w"))
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = base.select(
        F.col(key),
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"),
            F.size(F.filter(x, lambda s: s.rlike(r"^\s*[-*•]"))).alias("bullets"),
            F.size(F.filter(x, lambda s: s.rlike(r"(\.\.\.|…)\s*$"))).alias("ellipses"))).alias("_l"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        F.struct(
            F.regexp_count("_t", F.lit(_MARKED)).alias("marked"), F.regexp_count("_t", F.lit(_CAPITAL)).alias("capital"),
            F.size(F.filter("_w", lambda x: F.lower(x).isin(stops))).alias("stop")).alias("_k"),
    )
    n = F.col("n_words")

    def share(x: Column, of: Column = n) -> Column:
        return F.when(of > 0, x / of).otherwise(F.lit(0.0))

    return counted.select(
        key, "n_words", "word_chars", "n_symbols", F.col("_l.dup").cast("long").alias("n_dup_lines"), "n_repeat_words",
        share(F.col("word_chars")).alias("mean_word_chars"),
        share(F.col("n_symbols")).alias("symbol_ratio"),
        share(F.col("_k.marked")).alias("marked_word_ratio"),
        share(F.col("_k.capital")).alias("capital_word_ratio"),
        share(F.col("_k.stop")).alias("stop_word_ratio"),
        share(F.col("_l.dup"), F.col("_l.n")).alias("dup_line_ratio"),
        share(F.col("_l.bullets"), F.col("_l.n")).alias("bullet_line_ratio"),
        share(F.col("_l.ellipses"), F.col("_l.n")).alias("ellipsis_line_ratio"),
        share(F.col("n_repeat_words")).alias("repeat_word_ratio"),
    )


def verdict(thresholds=None) -> Column:
    """The threshold table as one boolean expression over the figures."""
    rules = THRESHOLDS if thresholds is None else thresholds
    out = F.lit(True)
    for name, low, high in rules:
        if low is not None:
            out = out & (F.col(name) >= F.lit(low))
        if high is not None:
            out = out & (F.col(name) <= F.lit(high))
    return out


def failed_rules(thresholds=None) -> Column:
    """Names of the rules that a row breaks, in the table's order."""
    rules = THRESHOLDS if thresholds is None else thresholds
    names = [F.when(~verdict([rule]), F.lit(rule[0])) for rule in rules]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", thresholds=None) -> DataFrame:
    """Figures, the base rule, the broken rules and the verdict per document."""
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return figures(docs, key, text).select(
        "*", base_failed.alias("base_failed"), failed_rules(thresholds).alias("failed_rules"),
        (~base_failed & verdict(thresholds)).alias("kept"))
