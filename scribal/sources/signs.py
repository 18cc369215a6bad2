"""Sign dictionary readers (S9): nested sign list and reading override list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.operators.lookups import SIGN_SCHEMA


def _named(key: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(key, T.StructType([T.StructField("n", T.StringType())]))]))


_FORM_BODY = T.StructType(
    [
        T.StructField("n", T.StringType()),
        T.StructField("sl:ucun", T.StringType()),
        T.StructField("j:aka", _named("sl:aka")),
        T.StructField("j:values", _named("sl:v")),
    ]
)
_SIGN_BODY = T.StructType(
    _FORM_BODY.fields
    + [T.StructField("j:forms", T.ArrayType(T.StructType([T.StructField("sl:form", _FORM_BODY)])))]
)
# letters -> signs -> sign: three fixed levels, so a plain struct schema
SIGN_LIST_SCHEMA = T.StructType(
    [
        T.StructField(
            "sl:signlist",
            T.StructType(
                [
                    T.StructField(
                        "j:letters",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField(
                                        "sl:letter",
                                        T.StructType(
                                            [
                                                T.StructField(
                                                    "j:signs",
                                                    T.ArrayType(
                                                        T.StructType([T.StructField("sl:sign", _SIGN_BODY)])
                                                    ),
                                                )
                                            ]
                                        ),
                                    )
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)


def _conform(body):
    """Dictionary field names -> :data:`SIGN_SCHEMA` field names."""
    return F.struct(
        body["n"].alias("n"),
        body["sl:ucun"].alias("ucun"),
        F.transform(body["j:aka"], lambda a: a["sl:aka"]["n"]).alias("aka"),
        # an entry without a reading becomes null and is skipped later
        F.transform(body["j:values"], lambda v: v["sl:v"]["n"]).alias("values"),
    )


def read_sign_list(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per sign (``sign`` column of :data:`SIGN_SCHEMA`).

    A dictionary file is a single JSON document of bounded size (a few tens
    of MB); it is parsed once and its signs exploded into parallel rows. With
    ``lines`` each line of the files is a document of its own, and large files
    are read in many tasks.
    """
    raw = spark.read.text(path, wholetext=not lines)
    doc = raw.select(F.from_json("value", SIGN_LIST_SCHEMA).alias("d"))
    letters = doc.select(F.explode("d.`sl:signlist`.`j:letters`").alias("l"))
    signs = letters.select(F.explode("l.`sl:letter`.`j:signs`").alias("s")).select(F.col("s.`sl:sign`").alias("b"))
    base = _conform(F.col("b"))
    forms = F.transform(F.col("b.`j:forms`"), lambda f: _conform(f["sl:form"]))
    sign = F.struct(base["n"], base["ucun"], base["aka"], base["values"], forms.alias("forms"))
    return signs.select(sign.cast(SIGN_SCHEMA).alias("sign"))


def read_reading_index(spark: SparkSession, path: str, key: str = "index", lines: bool = False) -> DataFrame:
    """``(reading, glyph_name)`` from a JSON object ``{key: {reading: name}}``, or
    with ``lines`` from one such object per line.

    A MAP keeps JSON member order and, like Python, the last duplicate wins.
    """
    raw = spark.read.text(path, wholetext=not lines)
    m = F.from_json("value", T.StructType([T.StructField(key, T.MapType(T.StringType(), T.StringType()))]))
    return raw.select(F.explode(m[key]).alias("reading", "glyph_name"))
