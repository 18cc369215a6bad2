"""Member-wise scan of one large JSON object.

A catalogue is a single JSON document, whose members are wanted one by one and in
order. Read as one value it is one row and one task. Here the file is read in
pieces that end at each closing brace, which Spark splits like lines; what a piece
means depends on what stands before it, and running sums over the pieces tell that:
the number of quotation marks says whether a brace stands in a string, so that the
next piece goes on, the braces outside strings how deep a piece begins, and how many
members have begun which member it belongs to. Sums run inside each split of the file and then over the
splits, one row each, so no task holds more than a split.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scribal.session import materialize

_STRING = r'"(?:[^"\\]|\\.)*+"'
_OPEN = rf'(?:[^{{"]|{_STRING})*+\{{'
_KEY = rf'(?:[^{{"]|{_STRING}(?!\s*:\s*\{{))*+"((?:[^"\\]|\\.)*+)"\s*:\s*\{{'


def running_sums(pieces: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """``pieces`` (split, at, ...) with the sums of each column over all pieces before."""
    before = Window.partitionBy("split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inner = pieces.select("*", *[c.cast("long").alias(f"_{n}") for n, c in sums.items()]).select(
        "*", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_in_{n}") for n in sums])
    inner = materialize(inner)
    totals = inner.groupBy(F.col("split").alias("_split")).agg(*[F.sum(f"_{n}").alias(f"_all_{n}") for n in sums])
    earlier = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)  # one row per split of the file
    starts = totals.select("_split", *[F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_start_{n}") for n in sums])
    joined = inner.join(starts, F.col("split") == F.col("_split"))
    return joined.select(*pieces.columns, *[(F.col(f"_start_{n}") + F.col(f"_in_{n}")).alias(n) for n in sums])


def _count(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def _plain(name: str) -> Column:
    """Text without escapes, which are parts of strings."""
    return F.regexp_replace(name, r"(?s)\\.", "")


def _begun(depth: Column, opens: Column, level: int) -> Column:
    """Whether an object of this level begins in a piece."""
    return (depth < level) & (depth + opens >= level)


def _head(body: Column, depth: Column, level: int, group: int) -> Column:
    """The key (group 1) of the object of this level that begins in a piece, or the
    text after its opening brace (group 2)."""
    out = F.lit(None).cast("string")
    for d in range(level - 1):
        pattern = rf"(?s)^(?:{_OPEN}){{{level - 1 - d}}}{_KEY}(.*)$"
        out = F.when(depth == d, F.regexp_extract(body, pattern, group)).otherwise(out)
    return F.when(depth == level - 1, F.regexp_extract(body, rf"(?s)^{_KEY}(.*)$", group)).otherwise(out)


def _unescaped(key: Column) -> Column:
    return F.from_json(F.concat(F.lit('["'), key, F.lit('"]')), "array<string>")[0]


def read_members(spark: SparkSession, path: str, container: str = "members") -> DataFrame:
    """``(pos, key, meta map<string,string>)`` per member of the object ``container``
    of the JSON document in ``path``, in member order; values that are no strings are
    JSON text. Of members with one key the last counts, in the place of the first."""
    raw = spark.read.option("lineSep", "}").text(path)
    pieces = raw.select(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value")
    pieces = materialize(pieces.withColumn("marks", _count(_plain("value"), '"')))
    told = running_sums(pieces, {"marks_before": F.col("marks")})
    ends = (F.col("marks_before") + F.col("marks")) % 2 == 0  # else the brace stands in a string, and the next piece goes on
    told = running_sums(told.withColumn("ends", ends.cast("int")), {"segment": F.col("ends")})
    parts = told.groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("parts"))  # one piece as a rule
    segments = materialize(parts.select(
        F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["at"].alias("at"), F.array_join(F.col("parts.value"), "}").alias("value"))
        .withColumn("opens", _count(F.regexp_replace(_plain("value"), '"[^"]*("|$)', ""), "{")))
    deep = running_sums(segments, {"depth": F.col("opens") - 1})
    depth, opens = F.col("depth"), F.col("opens")
    numbered = running_sums(deep, {"containers": _begun(depth, opens, 2).cast("int"), "members": _begun(depth, opens, 3).cast("int")})
    numbered = materialize(numbered.select(
        "split", "at", "value", "depth", "opens",
        (F.col("containers") + _begun(depth, opens, 2).cast("int")).alias("container"),
        _begun(depth, opens, 3).alias("starts"), F.col("members").alias("before"), (F.col("members") + _begun(depth, opens, 3).cast("int")).alias("member")))
    wanted = numbered.filter(_begun(depth, opens, 2)).select(
        F.col("container").alias("_container"), F.col("before").alias("_before"), _unescaped(_head(F.col("value"), depth, 2, 1)).alias("_name")).filter(F.col("_name") == container)
    held = numbered.filter(F.col("starts") | (depth >= 3)).join(F.broadcast(wanted.select("_container", "_before")), F.col("container") == F.col("_container"))
    text = F.when(F.col("starts"), F.concat(F.lit("{"), _head(F.col("value"), depth, 3, 2))).otherwise(F.col("value"))
    place = (F.col("member") - F.col("_before") - 1).alias("member")
    rows = held.select(place, "split", "at", F.when(F.col("starts"), _head(F.col("value"), depth, 3, 1)).alias("key"), F.concat(text, F.lit("}")).alias("text"))
    whole = rows.groupBy("member").agg(  # the pieces of one member
        F.max("key").alias("key"), F.array_sort(F.collect_list(F.struct("split", "at", "text"))).alias("parts"))
    parsed = whole.select("member", _unescaped(F.col("key")).alias("key"),
                          F.from_json(F.array_join(F.col("parts.text"), ""), "map<string,string>").alias("meta"))
    return parsed.groupBy("key").agg(F.min("member").alias("pos"), F.max_by("meta", "member").alias("meta")).select(
        "pos", "key", "meta")
