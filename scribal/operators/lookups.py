"""Lookup dimensions from a nested sign dictionary.

Input is one row per sign (see :data:`SIGN_SCHEMA`); the reader explodes
the dictionary's letter level. Everything here is explode + groupBy, so a
dictionary of any size is built in parallel and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FORM = T.StructType(
    [
        T.StructField("n", T.StringType()),
        T.StructField("ucun", T.StringType()),
        T.StructField("aka", T.ArrayType(T.StringType())),
        T.StructField("values", T.ArrayType(T.StringType())),
    ]
)
# one sign: name, codepoint(s), alias names, readings (null = an entry
# without a reading), and variant forms with the same shape
SIGN_SCHEMA = T.StructType(_FORM.fields + [T.StructField("forms", T.ArrayType(_FORM))])


def unescape_name(col: Column) -> Column:
    """L2: the dictionary escapes ``&`` in sign names."""
    return F.replace(col, F.lit("&amp;"), F.lit("&"))


def _name_pairs(n: Column, ucun: Column, aka: Column) -> Column:
    glyph = F.coalesce(ucun, F.lit(""))
    own = F.array(F.struct(n.alias("glyph_name"), glyph.alias("glyph")))
    akas = F.transform(F.coalesce(aka, F.array().cast("array<string>")),
                       lambda a: F.struct(a.alias("glyph_name"), glyph.alias("glyph")))
    return F.concat(own, akas)


def _reading_pairs(n: Column, values: Column) -> Column:
    vals = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isNotNull())
    return F.transform(vals, lambda v: F.struct(v.alias("reading"), n.alias("glyph_name")))


def glyph_pairs(signs: DataFrame, sign_col: str = "sign") -> DataFrame:
    """L1+L3: ``(glyph_name, glyph)`` for signs, aliases, forms, form aliases."""
    s = F.col(sign_col)
    forms = F.coalesce(s["forms"], F.array().cast(T.ArrayType(_FORM)))
    pairs = F.concat(
        _name_pairs(s["n"], s["ucun"], s["aka"]),
        F.flatten(F.transform(forms, lambda f: _name_pairs(f["n"], f["ucun"], f["aka"]))),
    )
    out = signs.select(F.explode(pairs).alias("p")).select("p.glyph_name", "p.glyph")
    return out.withColumn("glyph_name", unescape_name(F.col("glyph_name")))


def reading_pairs(signs: DataFrame, sign_col: str = "sign") -> DataFrame:
    """L1+L4: ``(reading, glyph_name)`` from sign and form readings (aliases
    contribute none; entries without a reading are skipped)."""
    s = F.col(sign_col)
    forms = F.coalesce(s["forms"], F.array().cast(T.ArrayType(_FORM)))
    pairs = F.concat(
        _reading_pairs(s["n"], s["values"]),
        F.flatten(F.transform(forms, lambda f: _reading_pairs(f["n"], f["values"]))),
    )
    out = signs.select(F.explode(pairs).alias("p")).select("p.reading", "p.glyph_name")
    return out.withColumn("glyph_name", unescape_name(F.col("glyph_name")))


def glyph_index(pairs: DataFrame) -> DataFrame:
    """L5+L7: one row per name: ``glyph`` ('' when none), ``n_candidates``.

    Names whose only codepoint is empty are kept (known name, no glyph).
    When a name has several codepoints the smallest is taken, so the
    choice is deterministic; ``n_candidates > 1`` flags it for review.
    """
    agg = pairs.groupBy("glyph_name").agg(F.sort_array(F.collect_set("glyph")).alias("_g"))
    nonempty = F.array_remove(F.col("_g"), "")
    return agg.select(
        "glyph_name",
        F.coalesce(F.array_min(nonempty), F.lit("")).alias("glyph"),
        F.size(nonempty).alias("n_candidates"),
    )


def reading_index(pairs: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """L5+L6: ``(reading, names array<string>)``, names sorted and distinct,
    empty names removed. ``override(reading, glyph_name)`` replaces a
    reading's names entirely by its single name (a full outer merge)."""
    base = pairs.groupBy("reading").agg(
        F.array_remove(F.sort_array(F.collect_set("glyph_name")), "").alias("names")
    )
    if override is None:
        return base
    ov = override.select(F.col("reading").alias("_r"), F.array(F.col("glyph_name")).alias("_n"))
    merged = base.join(ov, base["reading"] == ov["_r"], "full_outer")
    return merged.select(
        F.coalesce(F.col("_r"), F.col("reading")).alias("reading"),
        F.coalesce(F.col("_n"), F.col("names")).alias("names"),
    )


def invert(readings: DataFrame) -> DataFrame:
    """``(glyph_name, readings array<string>)`` - distinct readings per name."""
    return (
        readings.select("reading", F.explode("names").alias("glyph_name"))
        .groupBy("glyph_name")
        .agg(F.sort_array(F.collect_set("reading")).alias("readings"))
    )


def multi_codepoint_report(pairs: DataFrame) -> DataFrame:
    """L7 report: names mapped to more than one non-empty codepoint."""
    g = glyph_index(pairs)
    return g.filter(F.col("n_candidates") > 1)
