"""Exact stratified train / validation / test split.

Sizes follow stratified hold-out semantics: a hold-out takes
``ceil(N * num / den)`` rows overall; each stratum gets the floor of its
share plus one for the strata with the largest remainders (ties by
stratum value, null first). Inside a stratum the rows stand in the order of
one seeded hash of their key: the first ones are the test rows, the next
ones the validation rows, the others train. The split is reproducible and
independent of partitioning. A null stratum is a stratum like any other.

Scale: rows are hashed once. A histogram of 16-bit hash prefixes (an
aggregate, combined map-side) gives one row per stratum with the prefixes
at which test and validation end (written once: the input is read for the
histogram and for the result's two parts); rows are labelled by comparing prefixes,
and only those of the two boundary prefixes of each stratum are ranked. No
task ever sorts a whole stratum, however dominant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribal.session import materialize

_PREFIX = 4  # hex chars of the hash used as histogram bucket (65,536 buckets)


def _with_quota(counts: DataFrame, n: str, num: int, den: int, out: str) -> DataFrame:
    """The per-stratum table with each stratum's share ``out`` of a hold-out.

    The windows here run over one row per stratum.
    """
    whole = Window.partitionBy()
    largest = Window.orderBy(F.col("_rem").desc(), F.col("stratum").asc_nulls_first())
    q = counts.withColumn("_base", F.expr(f"({n} * {num}) div {den}")).withColumn("_rem", F.expr(f"({n} * {num}) % {den}"))
    # exact integer ceiling of N * num / den
    q = q.withColumn("_total", F.floor((F.sum(n).over(whole) * num + (den - 1)) / den).cast("bigint"))
    q = q.withColumn("_extra", F.col("_total") - F.sum("_base").over(whole)).withColumn("_rk", F.row_number().over(largest))
    more = F.when(F.col("_rk") <= F.col("_extra"), 1).otherwise(0)
    return q.withColumn(out, F.col("_base") + more).drop("_base", "_rem", "_total", "_extra", "_rk")


def _cuts(rows: DataFrame, test: tuple[int, int], validation: tuple[int, int]) -> DataFrame:
    """One row per stratum: the ranks where test and validation end, the
    prefix that holds each of them, and the rows before that prefix."""
    hist = materialize(rows.groupBy("stratum", "_b").agg(F.count(F.lit(1)).alias("_bn")))
    counts = _with_quota(hist.groupBy("stratum").agg(F.sum("_bn").alias("n")), "n", *test, "_test")
    counts = counts.withColumn("_rest", F.col("n") - F.col("_test"))
    counts = _with_quota(counts, "_rest", *validation, "_validation")
    ends = counts.select(F.col("stratum").alias("_s"), F.col("_test").alias("end_test"),
                         (F.col("_test") + F.col("_validation")).alias("end_validation"))
    upto = Window.partitionBy("stratum").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = hist.withColumn("_cum", F.sum("_bn").over(upto)).join(ends, F.col("stratum").eqNullSafe(F.col("_s")))

    def boundary(end: str) -> list[Column]:
        holds = (F.col("_cum") >= F.col(end)) & (F.col("_cum") - F.col("_bn") < F.col(end))
        return [F.max(F.when(holds, F.col("_b"))).alias(f"{end}_b"),
                F.max(F.when(holds, F.col("_cum") - F.col("_bn"))).alias(f"{end}_before")]

    return summed.groupBy("stratum").agg(
        F.max("end_test").alias("end_test"), F.max("end_validation").alias("end_validation"),
        *boundary("end_test"), *boundary("end_validation")).withColumnRenamed("stratum", "_s")


def _seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def numbered_splits(split: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """P5: add ``row_no``, each row's place (from 1) in its split's permutation: the
    order of one seeded hash of the key, then of the key.

    Rows are dealt by hash prefix and numbered inside it; a histogram of the
    prefixes, one row per split and prefix, gives the number that each starts with.
    So the numbers are dense and the same on any cluster, and no task sorts a split,
    however large. Sort by ``row_no`` inside files written per split to store it.
    """
    rows = materialize(split.select("*", _seeded_hash(key, seed).alias("_h")).withColumn("_b", F.substring("_h", 1, _PREFIX)))
    hist = rows.groupBy("split", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("split").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # 65,536 rows a split at most
    starts = hist.select("split", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("split", "_b").orderBy("_h", F.col(key).asc_nulls_first()))
    return rows.withColumn("_place", place).join(starts, ["split", "_b"]).select(
        *split.columns, (F.col("_start") + F.col("_place")).alias("row_no"))


def split_stratified(
    df: DataFrame,
    strata: str,
    key: str,
    route_to_train: Column | None = None,
    test: tuple[int, int] = (5, 100),
    validation: tuple[int, int] = (5, 95),
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` in {train, validation, test}.

    Rows matching ``route_to_train`` go to train only. The test sample is
    taken from the other rows, then the validation sample from what
    remains (5/95 of the remainder: 90/5/5 overall). Output is a bag (P5:
    order carries no meaning; sort by a seeded hash if an order is wanted).
    """
    routed = F.coalesce(route_to_train, F.lit(False)) if route_to_train is not None else F.lit(False)
    h = _seeded_hash(key, seed)
    rows = df.withColumn("_routed", routed).withColumn("_h", h).withColumn("_b", F.substring("_h", 1, _PREFIX))
    cuts = materialize(_cuts(rows.filter(~F.col("_routed")).select(F.col(strata).alias("stratum"), "_b"), test, validation))
    rows = rows.join(cuts, F.col(strata).eqNullSafe(F.col("_s")) & ~F.col("_routed"), "left")
    at_test, at_validation = (F.coalesce(F.col("_b") == F.col(f"{e}_b"), F.lit(False)) for e in ("end_test", "end_validation"))
    ranked = at_test | at_validation
    # a hold-out of no rows has no boundary prefix: nothing lies before it
    before = {e: F.coalesce(F.col("_b") < F.col(f"{e}_b"), F.lit(False)) for e in ("end_test", "end_validation")}
    easy = rows.filter(~ranked).withColumn(
        "split", F.when(before["end_test"], "test").when(before["end_validation"], "validation").otherwise("train"))
    in_prefix = Window.partitionBy(strata, "_b").orderBy("_h", key)
    start = F.when(at_test, F.col("end_test_before")).otherwise(F.col("end_validation_before"))
    rank = start + F.row_number().over(in_prefix)
    exact = rows.filter(ranked).withColumn("_rank", rank).withColumn(
        "split", F.when(F.col("_rank") <= F.col("end_test"), "test")
        .when(F.col("_rank") <= F.col("end_validation"), "validation").otherwise("train"))
    cols = [*df.columns, "split"]
    return easy.select(*cols).unionByName(exact.select(*cols))
