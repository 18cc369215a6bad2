"""Dataset reconciliation: two versions of a table, cell by cell (V1-V7).

Digests come first, in a tree of three levels:

1. *Rows.* One pass over each version writes a narrow table: key, bucket of the
   key, and digests of the whole row and of each cell. Texts are read here once
   and not again, except for the few cells that a sample shows.
2. *Buckets.* The row digests of each bucket are added up for both versions in one
   aggregate of at most ``BUCKETS`` rows per task. Equal sums end the matter.
3. *Keys.* In buckets that differ, the digests of each key are added up; only keys
   that differ go on, and only their cells' digests are held against each other.

Work beyond the first pass thus grows with what differs, not with the tables. The
text of a cell is read for sample keys only: at most ``SAMPLE_CELLS`` keys a
column, looked up by literal keys, which the Parquet reader uses to skip.

Digests have 64 bits, and bucket and key sums have 128. Null and empty are one
value. A null key is a key like any, except that its cells are compared with
nothing, as no row can be said to correspond. Rows of a key that occurs several
times are compared in all pairs, unless both versions hold the same rows under it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribal.operators.stats import row_hash
from scribal.session import materialize

#: Buckets of keys whose digests are compared first; each is one row of two sums.
BUCKETS = 1 << 14
SAMPLE_KEYS = 10
SAMPLE_CELLS = 3
SAMPLE_CHARS = 120
_SIDES = ["only_left", "only_right"]
_LEFT, _RIGHT = 1, -1


def _as_text(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def _first(df: DataFrame, group: str, key: str, k: int) -> DataFrame:
    """The first ``k`` rows of each group by key, with their place ``_rn``."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col(key).asc_nulls_last()))
    return df.withColumn("_rn", rank).filter(F.col("_rn") <= k)


def _listed(df: DataFrame, group: str, shown: Column, joiner: str) -> DataFrame:
    """``(group, sample)``: the few rows of each group in the order of ``_rn``."""
    listed = F.array_sort(F.collect_list(F.struct("_rn", shown.alias("_shown"))))
    return df.groupBy(group).agg(F.array_join(F.transform(listed, lambda x: x["_shown"]), joiner).alias("sample"))


def digest_rows(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str] = (), prints: bool = False) -> DataFrame:
    """``(side, key, bucket, h0, h1, cells, print)`` per row of both versions, written
    to the shared folder: ``side`` is 1 for the left and -1 for the right one, the
    row digest is two numbers, ``cells`` holds one digest per column, and ``print``
    (if asked) the row's part of the content fingerprint."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        cells = [_as_text(c) for c in cols]
        whole = [F.col(key).cast("string"), F.col(key).isNull(), *cells]
        part = F.conv(F.substring(row_hash([key, *cols]), 1, 15), 16, 10).cast("long") if prints else F.lit(None).cast("long")
        return df.select(
            F.lit(sign).alias("side"), F.col(key).alias("key"), F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket"),
            F.xxhash64(*whole).alias("h0"), F.xxhash64(F.lit(1), *whole).alias("h1"),
            F.array(*[F.xxhash64(c) for c in cells]).cast("array<long>").alias("cells"), part.alias("print"))

    return materialize(side(left, _LEFT).unionByName(side(right, _RIGHT)))


def _signed_sums() -> list[Column]:
    """Four sums that are zero when both sides hold the same row digests."""
    halves = [F.shiftright(h, 32) for h in ("h0", "h1")] + [F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)) for h in ("h0", "h1")]
    return [F.sum(F.col("side") * half).alias(f"_s{i}") for i, half in enumerate(halves)]


_UNEQUAL = " OR ".join(["n_left <> n_right", *[f"_s{i} <> 0" for i in range(4)]])


def _counts() -> list[Column]:
    return [F.count_if(F.col("side") == s).alias(name) for s, name in ((_LEFT, "n_left"), (_RIGHT, "n_right"))]


def differing_buckets(digests: DataFrame) -> DataFrame:
    """The buckets in which the versions differ; ``BUCKETS`` rows at most."""
    return digests.groupBy("bucket").agg(*_counts(), *_signed_sums()).filter(_UNEQUAL).select("bucket")


def differing_keys(digests: DataFrame) -> DataFrame:
    """``(key, n_left, n_right)`` of the keys whose rows differ or stand on one
    side only, written to the shared folder."""
    inside = digests.join(F.broadcast(differing_buckets(digests)), "bucket", "left_semi")  # BUCKETS rows at most
    return materialize(inside.groupBy("key").agg(*_counts(), *_signed_sums()).filter(_UNEQUAL).select("key", "n_left", "n_right"))


def key_diff(keys: DataFrame) -> DataFrame:
    """V3: ``(side, n, sample)`` for distinct keys present on one side only, from
    the differing keys."""
    side = F.when(F.col("n_right") == 0, F.lit(_SIDES[0])).when(F.col("n_left") == 0, F.lit(_SIDES[1]))
    single = keys.select(side.alias("side"), "key").filter(F.col("side").isNotNull())
    counts = single.groupBy("side").agg(F.count(F.lit(1)).alias("n"))
    samples = _listed(_first(single, "side", "key", SAMPLE_KEYS), "side", F.coalesce(F.col("key").cast("string"), F.lit("null")), ",")
    sides = keys.sparkSession.createDataFrame([(s,) for s in _SIDES], "side string")
    found = sides.join(counts, "side", "left").join(samples, "side", "left")
    return found.select("side", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("sample", F.lit("")).alias("sample"))


def key_diff_of(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """V3 alone: only the key columns are read."""
    return key_diff(differing_keys(digest_rows(left, right, key)))


def _pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"))


def differing_cells(digests: DataFrame, keys: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(key, column)`` per differing cell of the pairs of rows with one key."""
    shared = keys.filter("n_left > 0 AND n_right > 0").select(F.col("key").alias("_shared"))
    inside = digests.select("side", "key", "cells").join(shared, F.col("key") == F.col("_shared"), "left_semi")
    both = _pairs(inside.filter(F.col("side") == _LEFT), inside.filter(F.col("side") == _RIGHT), "key")
    unequal = F.zip_with("l.cells", "r.cells", lambda x, y: x != y)
    differs = F.filter(F.array(*[F.lit(c) for c in cols]), lambda c, i: F.get(unequal, i))
    return both.select(F.col("l.key").alias("key"), F.explode(differs).alias("column"))


def _cell_table(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str], digests: DataFrame, keys: DataFrame) -> DataFrame:
    diffs = materialize(differing_cells(digests, keys, cols))
    counts = materialize(diffs.groupBy("column").agg(F.count(F.lit(1)).alias("n")))
    chosen = _first(diffs.distinct(), "column", "key", SAMPLE_CELLS).select("key").distinct()
    wanted = [r["key"] for r in chosen.collect()]  # SAMPLE_CELLS keys per column at most

    def rows(df: DataFrame) -> DataFrame:
        return df.filter(F.col(key).isin(wanted) if wanted else F.lit(False)).select(key, *cols)

    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), (_as_text(f"l.{c}") != _as_text(f"r.{c}")).alias("diff"),
                 F.substring(_as_text(f"l.{c}"), 1, SAMPLE_CHARS).alias("left"), F.substring(_as_text(f"r.{c}"), 1, SAMPLE_CHARS).alias("right"))
        for c in cols])
    shown = _pairs(rows(left), rows(right), key).select(F.col(f"l.{key}").alias("key"), F.explode(cells).alias("c")).filter("c.diff")
    text = F.concat(F.col("key").cast("string"), F.lit(": "), "left", F.lit(" => "), "right")
    samples = _listed(_first(shown.select("key", "c.column", "c.left", "c.right"), "column", "key", SAMPLE_CELLS), "column", text, "\n")
    return counts.join(samples, "column")


def cell_diff(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """V4+V5: on shared keys, ``(column, n, sample)`` per differing column;
    null and empty string are equal. The sample shows the first keys with a
    difference, one a line, with both values cut to ``SAMPLE_CHARS``."""
    digests = digest_rows(left, right, key, cols)
    return _cell_table(left, right, key, cols, digests, differing_keys(digests))


def duplicate_keys(digests: DataFrame, side: str) -> DataFrame:
    """Keys occurring more than once (the comparison assumes unique keys)."""
    mine = digests.filter(F.col("side") == (_LEFT if side == "left" else _RIGHT))
    return mine.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _totals(digests: DataFrame) -> DataFrame:
    """One row: rows and duplicate keys of each side, and the content fingerprints
    of the rows whose key stands on both sides."""
    part = {n: F.sum(F.when(F.col("side") == s, F.col("print")).cast("decimal(38,0)")).alias(f"p_{n}")
            for s, n in ((_LEFT, "left"), (_RIGHT, "right"))}
    per_key = digests.groupBy("key").agg(*_counts(), *part.values())
    shared = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    nothing = F.lit(0).cast("decimal(38,0)")
    return per_key.agg(
        *[F.coalesce(F.sum(f"n_{s}"), F.lit(0)).cast("bigint").alias(f"rows_{s}") for s in ("left", "right")],
        *[F.count_if(F.col(f"n_{s}") > 1).alias(f"duplicate_keys_{s}") for s in ("left", "right")],
        *[F.coalesce(F.sum(F.when(shared, F.col(f"n_{s}"))), F.lit(0)).alias(f"shared_{s}") for s in ("left", "right")],
        *[F.coalesce(F.sum(F.when(shared, F.col(f"p_{s}"))), nothing).cast("string").alias(f"print_{s}") for s in ("left", "right")])


def reconcile(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """V1-V6 as one tidy table ``(check, column, n, detail)``.

    Checks: row counts, column-set differences (from schemas), keys on one
    side only, duplicate keys, per-column cell differences on shared keys,
    and whether the content fingerprints of the shared keys' rows agree.
    """
    spark = left.sparkSession
    lc, rc = set(left.columns), set(right.columns)
    common = [c for c in (cols or left.columns) if c in lc and c in rc and c != key]
    digests = digest_rows(left, right, key, common, prints=bool(common))
    keys = differing_keys(digests)

    def line(check: str, n: Column, detail: Column | None = None) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(F.lit(check).alias("check"), none.alias("column"), n.cast("bigint").alias("n"),
                        (none if detail is None else detail).alias("detail"))

    lines = [line(name, F.col(name)) for name in ("rows_left", "rows_right", "duplicate_keys_left", "duplicate_keys_right")]
    if common:
        equal = (F.col("shared_left") == F.col("shared_right")) & (F.col("print_left") == F.col("print_right"))
        lines.append(line("fingerprint_equal", equal, F.concat_ws(" vs ", "print_left", "print_right")))
    rows = [_totals(digests).select(F.explode(F.array(*lines)).alias("r")).select("r.*")]
    schema_rows = [("columns_only_left", c) for c in sorted(lc - rc)] + [("columns_only_right", c) for c in sorted(rc - lc)]
    if schema_rows:
        found = spark.createDataFrame(schema_rows, "check string, column string")
        rows.append(found.select("check", "column", F.lit(1).cast("bigint").alias("n"), F.lit(None).cast("string").alias("detail")))
    kd = materialize(key_diff(keys))
    rows.append(kd.select(F.col("side").alias("check"), F.lit(None).cast("string").alias("column"), "n", F.col("sample").alias("detail")))
    if common:
        cd = _cell_table(left, right, key, common, digests, keys)
        rows.append(cd.select(F.lit("cells").alias("check"), "column", "n", F.col("sample").alias("detail")))
    return reduce(DataFrame.unionByName, rows)


def union_splits(tables: Sequence[DataFrame]) -> DataFrame:
    """V7: the split files as one table (bag union by column name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
