"""Driver queries for lookup building.

The sign dictionary is derived from the vocabulary of ``documents``: one
sign per distinct lower-case word, named by its ASCII upper-casing, with
a cuneiform-block codepoint computed from the word, a 3-letter alias (so
aliases collide with other names: multi-codepoint names), readings = the
word and its 2-letter prefix (ambiguous readings), a variant form for long
words, and an override list for 5-letter words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribal.operators.lookups import SIGN_SCHEMA, glyph_index, glyph_pairs, invert, reading_index, reading_pairs
from scribal.plans.fixtures import table
from scribal.plans.registry import register

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()


def glyph_of(k: Column) -> Column:
    """The character U+12000 + k (k < 4096) via its UTF-8 bytes."""
    b3 = F.hex(F.lit(128) + F.floor(k / 64).cast("int"))
    b4 = F.hex(F.lit(128) + (k % 64))
    return F.decode(F.unhex(F.concat(F.lit("F092"), b3, b4)), "UTF-8")


def vocabulary(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w"))
    return words.filter(F.col("w") != "").distinct()


def _name(w: Column) -> Column:
    return F.translate(w, LOWER, UPPER)


def sign_rows(vocab: DataFrame) -> DataFrame:
    w = F.col("w")
    n = F.concat(_name(w), F.when(F.length(w) == 6, F.lit("&amp;")).otherwise(F.lit("")))
    k = (F.length(w) * 7 + F.ascii(w)) % 900
    ucun = F.when(F.length(w) % 7 == 0, F.lit("")).otherwise(glyph_of(k))
    aka = F.when(F.length(w) >= 4, F.array(_name(F.substring(w, 1, 3)))).otherwise(F.array().cast("array<string>"))
    values = F.when(F.length(w) == 3, F.array(w, F.lit(None).cast("string"))).otherwise(
        F.array(w, F.substring(w, 1, 2))
    )
    form = F.struct(
        F.concat(n, F.lit("@F")).alias("n"),
        glyph_of((k + 1) % 900).alias("ucun"),
        F.array().cast("array<string>").alias("aka"),
        F.array(F.concat(w, F.lit("f"))).alias("values"),
    )
    forms = F.when(F.length(w) >= 9, F.array(form)).otherwise(F.array().cast(SIGN_SCHEMA["forms"].dataType))
    sign = F.struct(n.alias("n"), ucun.alias("ucun"), aka.alias("aka"), values.alias("values"), forms.alias("forms"))
    return vocab.select(sign.cast(SIGN_SCHEMA).alias("sign"))


def override_rows(vocab: DataFrame) -> DataFrame:
    return vocab.filter(F.length("w") == 5).select(
        F.col("w").alias("reading"), F.concat(F.lit("Q"), _name(F.col("w"))).alias("glyph_name")
    )


def build_lookups(spark, sf_dir):
    from scribal.session import materialize

    vocab = materialize(vocabulary(spark, sf_dir))  # read by signs and overrides
    signs = sign_rows(vocab)  # a narrow projection: made again for less than it costs to write it
    readings = reading_index(reading_pairs(signs), override_rows(vocab))
    glyphs = glyph_index(glyph_pairs(signs))
    return readings, glyphs


# ---- SQL oracle: the same dictionary, flattened directly -----------------
_T = f"'{LOWER}', '{UPPER}'"
VOCAB_SQL = f"""
words AS (
  SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS w FROM documents)
  WHERE w <> ''
), s AS (
  SELECT w, translate(w, {_T}) || CASE WHEN length(w) = 6 THEN '&amp;' ELSE '' END AS n,
         (length(w) * 7 + ascii(w)) % 900 AS k
  FROM words
), gpairs AS (
  SELECT replace(glyph_name, '&amp;', '&') AS glyph_name, glyph FROM (
    SELECT n AS glyph_name, CASE WHEN length(w) % 7 = 0 THEN '' ELSE chr(CAST(73728 + k AS INTEGER)) END AS glyph FROM s
    UNION ALL
    SELECT translate(substr(w, 1, 3), {_T}), CASE WHEN length(w) % 7 = 0 THEN '' ELSE chr(CAST(73728 + k AS INTEGER)) END
    FROM s WHERE length(w) >= 4
    UNION ALL
    SELECT n || '@F', chr(CAST(73728 + (k + 1) % 900 AS INTEGER)) FROM s WHERE length(w) >= 9)
), rpairs AS (
  SELECT reading, replace(glyph_name, '&amp;', '&') AS glyph_name FROM (
    SELECT w AS reading, n AS glyph_name FROM s
    UNION ALL SELECT substr(w, 1, 2), n FROM s WHERE length(w) <> 3
    UNION ALL SELECT w || 'f', n || '@F' FROM s WHERE length(w) >= 9)
), rindex AS (
  SELECT reading, list_sort(list_distinct(list(glyph_name) FILTER (WHERE glyph_name <> ''))) AS names
  FROM rpairs GROUP BY reading
), ov AS (
  SELECT w AS reading, 'Q' || translate(w, {_T}) AS glyph_name FROM words WHERE length(w) = 5
), rmerged AS (
  SELECT coalesce(ov.reading, r.reading) AS reading,
         CASE WHEN ov.reading IS NOT NULL THEN [ov.glyph_name] ELSE r.names END AS names
  FROM rindex r FULL OUTER JOIN ov ON r.reading = ov.reading
)"""


def _names_out(df: DataFrame, key: str, arr: str) -> DataFrame:
    return df.select(key, F.array_join(arr, "|").alias(arr), F.size(arr).alias(f"n_{arr}"))


def _sql_names_out(key: str, arr: str, src: str) -> str:
    return (
        f"SELECT {key}, array_to_string(coalesce({arr}, []), '|') AS {arr}, "
        f"CAST(len(coalesce({arr}, [])) AS INT) AS n_{arr} FROM {src}"
    )


@register(
    "lookup_glyph_index",
    f"""WITH {VOCAB_SQL}
SELECT glyph_name, coalesce(min(glyph) FILTER (WHERE glyph <> ''), '') AS glyph,
       CAST(count(DISTINCT glyph) FILTER (WHERE glyph <> '') AS INT) AS n_candidates
FROM gpairs GROUP BY glyph_name""",
    "L1 L2 L3 L5 L7",
)
def lookup_glyph_index(spark, sf_dir):
    return glyph_index(glyph_pairs(sign_rows(vocabulary(spark, sf_dir))))


@register("lookup_reading_index", f"WITH {VOCAB_SQL}\n{_sql_names_out('reading', 'names', 'rindex')}", "L1 L4 L5")
def lookup_reading_index(spark, sf_dir):
    return _names_out(reading_index(reading_pairs(sign_rows(vocabulary(spark, sf_dir)))), "reading", "names")


@register("lookup_override", f"WITH {VOCAB_SQL}\n{_sql_names_out('reading', 'names', 'rmerged')}", "L6")
def lookup_override(spark, sf_dir):
    readings, _ = build_lookups(spark, sf_dir)
    return _names_out(readings, "reading", "names")


@register(
    "lookup_inverse",
    f"""WITH {VOCAB_SQL}, inv AS (
  SELECT glyph_name, list_sort(list_distinct(list(reading))) AS readings
  FROM (SELECT reading, unnest(names) AS glyph_name FROM rmerged) GROUP BY glyph_name
)
{_sql_names_out('glyph_name', 'readings', 'inv')}""",
    "L8",
)
def lookup_inverse(spark, sf_dir):
    readings, _ = build_lookups(spark, sf_dir)
    return _names_out(invert(readings), "glyph_name", "readings")
