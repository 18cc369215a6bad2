"""Document fingerprints: SimHash in built-in expressions only.

Fingerprints. A text's terms are its distinct words; a term weighs its length
(up to ``MOST_WEIGHT``), as long words are rarer. Every term's 128-bit hash votes
with its weight on each bit; a bit is set when more weight voted for it than
against it. Votes are sums of numbers that hold two 32-bit counters each, built
by one partial aggregation per document, so one row per document is shuffled.

Search. Fingerprints within ``RADIUS`` bits of a query differ in at most that
many of their ``BLOCKS`` blocks, so two blocks at least are equal. One table per
pair of blocks is keyed by the bits of both; a pair of fingerprints is counted in
the table of its first two equal blocks only. Buckets are cut into tiles of
bounded size, so a bucket of any size is spread and never meets in one task; the
result lists the neighbours of a query tile by tile.

Edited texts (``edited_texts``): the last half of a text gives way to the beginning
of the next document in descending key order (after the last: the first).

Defined results: null, empty and blank texts have no terms and fingerprint 0;
rows equal in key and text are one document in the order and get equal results;
rows that share a key only are ordered by a hash of their texts; a null key comes
last. Only the key and text columns are used.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribal.llm.common import bind, mark, need, small, words, written

BITS = 128
MOST_WEIGHT = 16
BLOCKS, BLOCK_BITS = 8, 16
RADIUS = 6
#: Fingerprints of a bucket that stand in one list.
TILE = 512
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF
_ROW_BITS = 33


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` with their text's fingerprint as two numbers, ``hi`` and ``lo``.

    Rows with equal keys must have equal texts: their votes only scale."""
    terms = texts.select(*keys, F.explode_outer(F.array_distinct(words(F.col(text)))).alias("_term"))
    hashed = terms.select(
        *keys, F.xxhash64("_term").alias("_h0"), F.xxhash64(F.lit(7), "_term").alias("_h1"),
        F.when(F.col("_term").isNull(), F.lit(0)).otherwise(F.least(F.length("_term"), F.lit(MOST_WEIGHT)))
        .cast("long").alias("_w"))
    half = BITS // 4
    votes = [F.sum(F.shiftright(f"_h{h}", k).bitwiseAND(F.lit(_LANES)) * F.col("_w")).alias(f"_v{h}_{k}")
             for h in (0, 1) for k in range(half)]
    summed = hashed.groupBy(*keys).agg(F.sum("_w").alias("_all"), *votes)

    def number(h: int) -> Column:
        def bit(lane: Column, at: int) -> Column:
            return F.shiftleft((2 * lane > F.col("_all")).cast("long"), at)

        low = [bit(F.col(f"_v{h}_{k}").bitwiseAND(F.lit(_LOW)), k) for k in range(half)]
        high = [bit(F.shiftrightunsigned(f"_v{h}_{k}", 32), k + half) for k in range(half)]
        return reduce(lambda a, b: a.bitwiseOR(b), [*low, *high])

    return summed.select(*keys, number(0).alias("hi"), number(1).alias("lo"))


def hamming(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - hamming(a, b) / F.lit(float(BITS))


def hexed(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def _block(hi: Column, lo: Column, b: int) -> Column:
    per = 64 // BLOCK_BITS
    return F.shiftrightunsigned(hi if b < per else lo, BLOCK_BITS * (b % per)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _tables(hi: Column, lo: Column) -> Column:
    """The bucket of a fingerprint in every table: (mask of its two blocks, bits)."""
    return F.array(*[
        F.struct(F.lit((1 << i) | (1 << j)).alias("mask"),
                 F.shiftleft(_block(hi, lo, i), BLOCK_BITS).bitwiseOR(_block(hi, lo, j)).alias("bits"))
        for i, j in combinations(range(BLOCKS), 2)])


def _first_two_equal(hi: Column, lo: Column) -> Column:
    """Mask of the first two equal blocks, of the difference of two fingerprints."""
    equal = reduce(lambda a, b: a + b, [
        F.when(_block(hi, lo, b) == 0, F.lit(1 << b)).otherwise(F.lit(0)) for b in range(BLOCKS)])

    def two(z: Column) -> Column:
        lowest = z.bitwiseAND(-z)
        rest = z.bitwiseXOR(lowest)
        return lowest.bitwiseOR(rest.bitwiseAND(-rest))

    return bind(equal, two)


def within_radius(queries: DataFrame, stored: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(q_hi, q_lo, near)``: the stored fingerprints within ``radius`` bits of
    each query fingerprint, an equal one included, in lists of at most ``TILE`` with
    the number ``n`` of stored rows that each stands for.

    Both inputs are columns ``hi``, ``lo``. With ``BLOCKS`` blocks the radius may be
    ``BLOCKS - 2`` at most.
    """
    if radius > BLOCKS - 2:
        raise ValueError(f"with {BLOCKS} blocks the radius is {BLOCKS - 2} at most")
    asked = queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo")).distinct()
    asked = written(asked.select("q_hi", "q_lo", F.explode(_tables(F.col("q_hi"), F.col("q_lo"))).alias("at"))
                    .select("at.mask", "at.bits", "q_hi", "q_lo"))
    wanted = asked.select("mask", "bits").distinct()
    kept = stored.groupBy("hi", "lo").agg(F.count("*").alias("n_rows"))
    kept = kept.select("hi", "lo", "n_rows", F.explode(_tables(F.col("hi"), F.col("lo"))).alias("at")).select(
        "at.mask", "at.bits", "hi", "lo", "n_rows")
    hits = written(kept.join(small(wanted), ["mask", "bits"], "left_semi"))
    sizes = hits.groupBy("mask", "bits").agg(F.count("*").alias("n"))
    tile = F.pmod(F.xxhash64("hi", "lo"), F.ceil(2 * F.col("n") / TILE).cast("long"))
    tiles = (hits.join(sizes, ["mask", "bits"]).withColumn("tile", tile)
             .groupBy("mask", "bits", "tile").agg(F.collect_list(F.struct("hi", "lo", F.col("n_rows").alias("n"))).alias("members")))

    def near(x: Column) -> Column:
        hi, lo = x["hi"].bitwiseXOR(F.col("q_hi")), x["lo"].bitwiseXOR(F.col("q_lo"))
        distance = F.bit_count(hi) + F.bit_count(lo)
        return (distance <= radius) & (_first_two_equal(hi, lo) == F.col("mask"))

    found = asked.join(tiles, ["mask", "bits"]).select("q_hi", "q_lo", F.filter("members", near).alias("near"))
    return found.where(F.size("near") > 0)


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their place ``rank``, from 0, in a total order: range
    partitions, sorted, numbered, and shifted by the rows of those before."""
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select(  # one row per partition
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return dealt.join(starts, "_part").select(*rows.columns, place.alias("rank"))


def next_documents(docs: DataFrame) -> DataFrame:
    """``(key, mark, cut, next_key, next_mark)`` for documents of (key, mark);
    ``cut``: how many characters of the next one the edited text takes."""
    listed = docs.select("key", "mark", F.expr("length(text) div 2").alias("cut")).distinct()
    places = written(ranked(listed, [F.col("key").desc_nulls_last(), F.col("mark").asc()]))
    total = max(1, places.count())
    after = places.select(F.col("key").alias("next_key"), F.col("mark").alias("next_mark"), F.col("rank").alias("at"))
    with_next = places.withColumn("at", (F.col("rank") + 1) % total)
    return written(with_next.join(after, "at").select("key", "mark", "cut", "next_key", "next_mark"))


def _same(a: str, b: str, key: str = "key", mark: str = "mark") -> Column:
    return F.col(f"{a}.{key}").eqNullSafe(F.col(f"{b}.key")) & (F.col(f"{a}.{mark}") == F.col(f"{b}.mark"))


def documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, mark, text)``: texts without nulls, marked by their hash."""
    need(docs, [key, text])
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), mark(F.col(text)).alias("mark"), body.alias("text"))


def edited_texts(rows: DataFrame, following: DataFrame) -> DataFrame:
    """``(key, mark, edited)`` per row of ``documents``. Only what an edited
    text takes of its two texts is shuffled."""
    cut = F.expr("length(text) div 2")
    own = rows.select("key", "mark", F.substring("text", F.lit(1), F.length("text") - cut).alias("kept"))
    # beginnings go to the document before them, once for equal rows
    given = (rows.alias("r").join(small(following).alias("l"), F.col("r.key").eqNullSafe(F.col("l.next_key"))
                                  & (F.col("r.mark") == F.col("l.next_mark")))
             .select(F.col("l.key"), F.col("l.mark"), F.expr("substring(r.text, 1, l.cut)").alias("given"))
             .dropDuplicates(["key", "mark"]))
    both = own.alias("o").join(given.alias("g"), _same("o", "g"))
    return both.select("o.key", "o.mark", F.concat("o.kept", "g.given").alias("edited"))


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: characters, fingerprints of the text and the edited text,
    the edited text's digest, likeness to it and to the next document."""
    rows = documents(docs, key, text)
    following = next_documents(rows)
    sized = rows.withColumn("n_chars", F.length("text").cast("long"))
    own = written(fingerprints(sized, ["key", "mark", "n_chars"], "text"))
    edited = edited_texts(rows, following).withColumn("sha", F.sha2("edited", 256))
    changed = fingerprints(edited, ["key", "mark", "sha"], "edited")
    copies = rows.groupBy("key", "mark").agg(F.count("*").alias("copies"))
    joined = (
        own.alias("o").join(changed.alias("e"), _same("o", "e")).join(following.alias("f"), _same("o", "f"))
        .join(own.alias("n"), _same("f", "n", "next_key", "next_mark")).join(copies.alias("c"), _same("o", "c"))
        .withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    pair = {s: (F.col(f"{s}.hi"), F.col(f"{s}.lo")) for s in ("o", "e", "n")}
    return joined.select(
        F.col("o.key").alias(key), F.col("o.n_chars").alias("n_chars"), F.col("e.sha").alias("edited_sha256"),
        F.col("o.hi").alias("hi"), F.col("o.lo").alias("lo"), hexed(*pair["o"]).alias("fingerprint"),
        hexed(*pair["e"]).alias("edited_fingerprint"), likeness(pair["o"], pair["e"]).alias("near_edited"),
        likeness(pair["o"], pair["n"]).alias("near_next"))
