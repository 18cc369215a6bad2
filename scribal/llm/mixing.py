"""Mixing sources to target weights by systematic sampling.

Every document gets an expected number of copies (its source's target over the
source's size). Within a source these are summed up in document order, one
random offset is added, and a document is emitted once for every whole number
that its stretch of the sum crosses. Sums are integers in units of 2**-24
copies, so they are exact whatever the order in which partial sums meet.

The running sum is distributed: rows are range-partitioned by (source, size,
key), each partition sums up what it holds of each source, those block sums
(one row per partition and source) are summed up per source, and every row adds
its block's start. A source that holds a third of all rows is spread over a
third of the partitions; no task ever holds a whole source. Within a source the
order is by size, so the sample holds every size in proportion and the words
taken lie within about one document of the target.

Defined results: a null source is a source of its own, ordered last; a null or
blank text has size 0 and may be taken any number of times up to its expected
copies; repeated rows are separate documents; an empty table gives an empty
result. Other columns are not carried, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribal.llm.common import mark, need, one_of_equal, small, unused, words, written

UNIT_BITS = 24
UNIT = 1 << UNIT_BITS
WEIGHTS = (5, 2, 1)
#: The mix holds this many words per hundred of the corpus.
SHARE_PERCENT = 150
#: No source is taken more often than this.
MAX_COPIES = 2
SEED = "mix-1"
#: Bits of the row number within its partition, as monotonically_increasing_id sets them.
_ROW_BITS = 33


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """``(source, source_size)`` -> one row per source with its target.

    Targets are in proportion to the weights (dealt to the sources in code
    point order, null last, repeating), stop at ``max_copies`` times the
    source's size, and what is over is shared again by weight. That fixed
    point is found in one pass: sources are ordered by the level at which they
    fill up; the first one that does not fill sets the level for the rest.
    The windows here run over one row per source, not over documents.
    """
    everything = Window.partitionBy()
    by_name = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    by_level = Window.partitionBy(F.lit(1)).orderBy("_level", F.col("source").asc_nulls_last())
    before, here_on = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    table = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    ranked = sizes.withColumn("_w", F.get(table, (F.row_number().over(by_name) - 1) % len(weights)))
    ranked = ranked.withColumn("_cap", max_copies * F.col("source_size"))
    ranked = ranked.withColumn("_level", F.col("_cap") / F.col("_w"))
    ranked = (
        # a hundred times the words that are left when the sources before are full
        ranked.withColumn("_left", share_percent * F.sum("source_size").over(everything)
                          - 100 * F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_wsum", F.sum("_w").over(here_on))
        .withColumn("_full", 100 * F.col("_cap") * F.col("_wsum") <= F.col("_w") * F.col("_left"))
    )
    first = F.min(F.when(~F.col("_full"), F.struct("_level", F.col("source").isNull(), "source", "_left", "_wsum")))
    ranked = ranked.withColumn("_first", first.over(everything))
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        (F.col("_w") * F.col("_first._left")).cast("double") / (100 * F.col("_first._wsum")).cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def _offset(seed: str) -> Column:
    """One offset below a whole copy per source, from the seed and its name."""
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), name)), 1, 6), 16, 10).cast("bigint")


def running_sum(rows: DataFrame, value: str, group: str, order: Sequence[str], out: str) -> DataFrame:
    """``rows`` with the sum of the integer ``value`` over its group's rows
    before and including this one, in ``order``, without any task that holds
    a whole group."""
    dealt = written(
        rows.repartitionByRange(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
        .sortWithinPartitions(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS)))
    blocks = dealt.groupBy(group, "_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col(group).alias("_group"), F.col("_part").alias("_block"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("_inner", F.sum(value).over(within))
    joined = summed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_block")))
    return joined.select(*rows.columns, (F.col("_start") + F.col("_inner")).alias(out))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """Per document: key, mark of its text, size (words), its source's size and
    target, copies."""
    need(docs, [key, text, source])
    sized = written(docs.select(
        F.col(key).alias("_key"), mark(F.col(text)).alias("mark"), F.col(source).alias("source"),
        F.size(words(F.col(text))).cast("bigint").alias("size")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights, share_percent, max_copies).select(
        F.col("source").alias("_source"), "source_size", "target")
    expected = F.when(
        F.col("source_size") > 0,
        F.floor(F.col("target") / F.col("source_size") * F.lit(float(UNIT))).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_key", "mark", "source", "size", "source_size", "target", expected.alias("_units"))
    summed = running_sum(rows, "_units", "source", ["size", "_key", "mark"], "_upto")
    upto = F.col("_upto") + _offset(seed)
    copies = F.shiftright(upto, UNIT_BITS) - F.shiftright(upto - F.col("_units"), UNIT_BITS)
    return summed.select(F.col("_key").alias(key), "mark", "source", "size", "source_size", "target", copies.alias("copies"))


def emit(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """``docs`` with every row as often as the mix takes it. Equal rows (key,
    text and source) come as often as all of them together."""
    k, m, of, n, own, copy = unused(docs, "_key", "_mark", "_source", "_copies", "_own", "_copy")
    drawn = mix(docs.select(*dict.fromkeys([key, text, source])), key, text, source, **settings)
    taken = written(drawn.groupBy(F.col(key).alias(k), F.col("mark").alias(m), F.col("source").alias(of)).agg(
        F.sum("copies").cast("int").alias(n), F.count("*").alias("rows")).where(F.col(n) > 0))
    marked = docs.withColumn(own, mark(F.col(text)))
    same = F.col(key).eqNullSafe(F.col(k)) & (F.col(own) == F.col(m)) & F.col(source).eqNullSafe(F.col(of))
    many = taken.where("rows > 1").select(k, m, of)
    single = one_of_equal(marked, many, same, [key, own, source])
    joined = single.join(small(taken.drop("rows")), same)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
