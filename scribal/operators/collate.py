"""Collation: union many sources, filter, keep-first dedup, standardise.

Row order is semantic upstream ("first" wins), and Spark has no implicit
row order, so every row carries one number ``ord``: its source's position in
the union, then the row's given position inside its source. "First" means the
smallest ``ord``.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribal.functions import rule_values as V
from scribal.session import materialize

ORD = "ord"

# Bits of ``ord`` that hold the position inside a source.
POS_BITS = 40


def order_number(corpus_rank: int, pos: Column) -> Column:
    """``ord`` from a source's rank and a position of up to 40 bits."""
    return F.lit(corpus_rank << POS_BITS).cast("bigint") + pos.cast("bigint")


def order_parts(order: Column) -> tuple[Column, Column]:
    """``(corpus_rank, pos)`` of an ``ord``."""
    return F.shiftright(order, POS_BITS).cast("int"), order.bitwiseAND(F.lit((1 << POS_BITS) - 1))


def file_positions(df: DataFrame) -> DataFrame:
    """``df``, read from Parquet files, with ``pos``: its rows numbered from 0 in the
    order of the files' paths and of the rows in each file, whatever Spark reads
    first. One pass over the files' row numbers gives each file's first position."""
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    sizes = df.select(path.alias("_file"), row.alias("_row")).groupBy("_file").agg((F.max("_row") + 1).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    placed = df.select("*", path.alias("_file"), row.alias("_row")).join(starts, "_file")
    return placed.select(*df.columns, (F.col("_start") + F.col("_row")).alias("pos"))


def with_ord(df: DataFrame, corpus_rank: int, pos: Column | str | None = None) -> DataFrame:
    """Attach ``ord``. Spark reads larger splits first, so no generated id follows
    the order of files: the position is given, or (None) taken from the Parquet files
    that ``df`` is read from."""
    if pos is None:
        return file_positions(df).withColumn(ORD, order_number(corpus_rank, F.col("pos"))).drop("pos")
    return df.withColumn(ORD, order_number(corpus_rank, F.col(pos) if isinstance(pos, str) else pos))


def union_common(tables: Sequence[DataFrame]) -> DataFrame:
    """Bag union on the columns every table has (first table's order).

    Column intersection is computed from schemas on the driver; no data
    moves. Every table must carry ``ord`` (see :func:`with_ord`).
    """
    if not tables:
        raise ValueError("nothing to union")
    if any(ORD not in t.columns for t in tables):
        raise ValueError(f"every table needs the column {ORD}")
    common = [c for c in tables[0].columns if all(c in t.columns for t in tables[1:])]
    return reduce(lambda a, b: a.unionByName(b), [t.select(*common) for t in tables])


def default_filters() -> list[Column]:
    """C2-C5 predicates of the upstream collation step."""
    return [
        F.col("language").isin(*V.KEPT_LANGUAGES),
        ~F.coalesce(F.col("langs").contains(V.EXCLUDED_LANGS_SUBSTRING), F.lit(False)),
        ~F.col("period").isin(*V.EXCLUDED_PERIODS),
        F.col("genre") != F.lit(V.EXCLUDED_GENRE),
        F.col("transliteration") != F.lit(""),
    ]


def apply_filters(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    return reduce(lambda d, p: d.filter(p), predicates, df)


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """The key as one value of fixed size: a number as it is, else a sha-256; a
    null single key stays null."""
    kinds = dict(df.dtypes)
    if len(keys) > 1:
        return F.sha2(F.to_json(F.struct(*keys)), 256)  # a null field is left out, an empty one is not
    kind = kinds[keys[0]]
    if kind == "string":
        return F.sha2(F.col(keys[0]), 256)
    return F.col(keys[0]) if "<" not in kind else F.sha2(F.to_json(F.struct(*keys)), 256)


_TIE_BITS = 63


def keep_first_in_turn(df: DataFrame, turns: Sequence[Sequence[str]], order_col: str = ORD) -> DataFrame:
    """Several keep-firsts, each among the rows that the one before has kept.

    The input is evaluated once: it is written with the hashes of its keys. From
    there only narrow columns are read: the least order number per key is a hash
    aggregate of fixed-size values, combined map-side before the shuffle, so a key
    holding a third of all rows still sends one row per input partition. Rows that
    tie in the order number are told apart by where they stand in the written
    table, so exactly one row per key stays, equal rows included. Null keys are one
    key. What does not stay, as a rule little, is taken out by one anti join.
    """
    names = [f"_k{i}" for i in range(len(turns))]
    while set(names) & set(df.columns):
        names = [f"_{n}" for n in names]
    table = materialize(df.select("*", *[key_hash(df, keys).alias(n) for n, keys in zip(names, turns)]))
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index").bitwiseAND(F.lit((1 << _TIE_BITS) - 1))
    at = F.col(order_col).cast("decimal(19,0)") * F.lit(Decimal(1 << _TIE_BITS)) + place.cast("decimal(19,0)")
    rows = table.select("*", at.cast("decimal(38,0)").alias("_at"))
    narrow, left = rows.select("_at", *names), None
    for n in names:
        among = narrow if left is None else narrow.join(left, "_at", "left_semi")
        left = materialize(among.groupBy(n).agg(F.min("_at").alias("_at")).select("_at"))
    gone = materialize(narrow.select("_at").join(left, "_at", "left_anti"))
    return rows.join(gone, "_at", "left_anti").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str = ORD) -> DataFrame:
    """For each key keep one row, that with the smallest ``order_col``
    (of several with the same number, one)."""
    return keep_first_in_turn(df, [list(keys)], order_col)


def collapse_values(col: Column, values: Sequence[str], to: str) -> Column:
    """Map a set of values to one value."""
    return F.when(col.isin(*values), F.lit(to)).otherwise(col)


def close_mapping(pairs: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Resolve ordered ``value == raw -> canonical`` updates to one lookup.

    Applying the pairs in order to an evolving value equals one lookup in
    the closed map (computed on the driver from the rule table only).
    """
    domain = {a for a, _ in pairs} | {b for _, b in pairs}
    closed = {}
    for v in domain:
        cur = v
        for raw, canonical in pairs:
            if cur == raw:
                cur = canonical
        if cur != v:
            closed[v] = cur
    return closed


def standardise(df: DataFrame, col: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Ordered raw -> canonical replacement of whole values."""
    closed = close_mapping(pairs)
    if not closed:
        return df
    expr = None
    for raw, canonical in sorted(closed.items()):
        cond = F.col(col) == F.lit(raw)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    return df.withColumn(col, expr.otherwise(F.col(col)))


def collate(
    tables: Sequence[DataFrame],
    filters: Sequence[Column] | None = None,
    key: str = "id",
    keep: Sequence[str] = ("id", "transliteration", "period", "genre"),
    period_col: str = "period",
    genre_col: str = "genre",
    genre_rules: Sequence[tuple[str, str]] = tuple(V.GENRE_NORMALIZATION),
) -> DataFrame:
    """Union on common columns, filter, keep first per key, project,
    collapse unknown periods, standardise genres. ``ord`` is kept."""
    df = union_common(tables)
    df = apply_filters(df, default_filters() if filters is None else filters)
    df = keep_first(df.select(*keep, ORD), [key])
    df = df.withColumn(period_col, collapse_values(F.col(period_col), V.UNKNOWN_PERIOD_VALUES, V.UNKNOWN_PERIOD))
    return standardise(df, genre_col, genre_rules)
