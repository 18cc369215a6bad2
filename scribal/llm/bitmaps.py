"""Hashed bitmaps of sets: bit counts bound from above what two sets share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribal.llm.common import is_empty, small, written

#: Bits of the shortest bitmap, and of the longest that goes to groups of sets.
LEAST_BITS, GROUP_BITS = 256, 8192
#: Places of more sets than this are crowded: all their pairs would be far more than their sets.
CROWD = 32


def bitmap_bits(size: int) -> int:
    """Length of a set's bitmap: a power of two, four times its size or more."""
    return max(LEAST_BITS, 1 << max(0, 4 * size - 1).bit_length())


def bitmap(values: np.ndarray) -> bytes:
    """The set's bitmap by the leading bits of its hashes."""
    bits = bitmap_bits(len(values))
    out = np.zeros(bits, dtype=bool)
    out[(values >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def folded(raw: np.ndarray, length: int) -> np.ndarray:
    """Bitmaps (rows of bytes) folded to ``length`` bits."""
    if raw.shape[1] * 8 == length:
        return raw
    return np.packbits(np.unpackbits(raw, axis=1).reshape(len(raw), length, -1).any(axis=2), axis=1)


class Bitmaps:
    """The bitmaps of some sets, ready to be held against each other."""

    def __init__(self, bits: list[bytes]):
        self.lengths = np.array([8 * len(b) for b in bits], dtype=np.int64)
        self.rows = {n: np.flatnonzero(self.lengths == n) for n in np.unique(self.lengths).tolist()}
        self.raw = {n: np.frombuffer(b"".join(bits[i] for i in at.tolist()), dtype=np.uint8).reshape(len(at), n // 8)
                    for n, at in self.rows.items()}

    def _at(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of all bitmaps of this length or more, folded, and where each set's stand."""
        place = np.zeros(len(self.lengths), dtype=np.int64)
        parts, begin = [], 0
        for n, at in self.rows.items():
            if n >= length:
                place[at] = begin + np.arange(len(at))
                begin += len(at)
                parts.append(folded(self.raw[n], length))
        return np.ascontiguousarray(np.concatenate(parts)).view(np.uint64), place

    def most_common(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The most values that the sets of each pair of places can share."""
        out = np.zeros(len(x), dtype=np.int64)
        short = np.minimum(self.lengths[x], self.lengths[y]) if len(x) else np.empty(0, dtype=np.int64)
        for length in np.unique(short).tolist():
            words, place = self._at(length)
            pairs = np.flatnonzero(short == length)
            step = max(1, (1 << 22) // words.shape[1])
            for at in range(0, len(pairs), step):
                p = pairs[at:at + step]
                a, b = words[place[x[p]]], words[place[y[p]]]
                out[p] = np.minimum(sizes[x[p]] - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64),
                                    sizes[y[p]] - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))
        return out


def allowed(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, maps: Bitmaps, percent: int) -> np.ndarray:
    """Which pairs of places sizes and bitmaps allow to be linked."""
    keep = percent * np.maximum(sizes[x], sizes[y]) <= 100 * np.minimum(sizes[x], sizes[y])
    at = np.flatnonzero(keep)
    most = maps.most_common(x[at], y[at], sizes)
    keep[at] = 100 * most >= percent * (sizes[x[at]] + sizes[y[at]] - most)
    return keep


def pass_bitmaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps let through, with the ``bound`` of
    their similarity. ``sets`` is (sid, size, bits), once per set."""
    asked = written(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct())
    known = written(sets.select("sid", "size", "bits").join(small(asked), "sid"))
    side = {s: known.select(F.col("sid").alias(s), F.col("size").alias(f"size_{s}"), F.col("bits").alias(f"bits_{s}"))
            for s in ("a", "b")}
    fits = percent * F.greatest("size_a", "size_b") <= 100 * F.least("size_a", "size_b")
    sized = pairs.join(side["a"].drop("bits_a"), "a").join(side["b"].drop("bits_b"), "b").where(fits).select("a", "b")
    both = sized.join(side["a"], "a").join(side["b"], "b")

    def batches(it):
        for whole in it:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                n = len(batch)
                d = batch.select(["size_a", "bits_a", "size_b", "bits_b"]).to_pydict()
                sizes = np.array(d["size_a"] + d["size_b"], dtype=np.int64)
                most = Bitmaps(d["bits_a"] + d["bits_b"]).most_common(np.arange(n), np.arange(n, 2 * n), sizes)
                union = sizes[:n] + sizes[n:] - most
                out = pa.RecordBatch.from_arrays([*batch.select(["a", "b"]).columns, pa.array(most / np.maximum(union, 1))], names=["a", "b", "bound"])
                yield out.filter(pa.array(100 * most >= percent * union))

    return both.select("a", "b", "size_a", "bits_a", "size_b", "bits_b").mapInArrow(batches, "a long, b long, bound double")


def likeliest() -> Column:
    """Picks the set that shares places with most others (``known``), of equal ones the least."""
    return F.struct(-F.col("known"), F.col("sid"))


def any_one() -> Column:
    """Picks a set by chance, one of a few orders of the sets by each place, so that
    a set meets few pivots."""
    return F.xxhash64("sid", F.pmod("place", F.lit(4)))


def crowded(members: DataFrame) -> DataFrame:
    """The members of crowded places. In the others all pairs are compared for less
    than another round of pivots takes."""
    counts = members.groupBy("place").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    return written(members.join(small(written(counts.select("place"))), "place"))


def crossing(rows: DataFrame) -> DataFrame:
    """The places of ``rows`` (place, label) that hold several components."""
    return written(rows.groupBy("place").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("place"))


def against_one(members: DataFrame, pick: Column, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of each member (sid, place, label) and the pivot that its place picks
    (the least ``pick``), of another component; of several each member keeps the
    likeliest."""
    pivots = written(members.groupBy("place").agg(F.min_by(F.struct("sid", "label"), pick).alias("one")))
    met = members.join(small(pivots.select("place", F.col("one.sid").alias("pivot"), F.col("one.label").alias("of_pivot")), of=pivots), "place")
    pairs = written(met.where("label <> of_pivot").select(F.greatest("sid", "pivot").alias("a"), F.least("sid", "pivot").alias("b"), F.col("sid").alias("of"))
                    .groupBy("a", "b").agg(F.max("of").alias("of")))
    if is_empty(pairs):
        return pairs.select("a", "b")
    likely = pass_bitmaps(pairs.select("a", "b"), sets, percent).join(pairs, ["a", "b"])
    best = likely.groupBy("of").agg(F.max_by(F.struct("a", "b"), F.struct("bound", "a", "b")).alias("p"))
    return best.select("p.a", "p.b").distinct()


def pairs_within(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows (x < y) within stretches."""
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    after = size[owner] - 1 - place
    x = np.repeat(begin[owner] + place, after)
    return x, x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(after) - after, after)


def open_pairs(members: DataFrame, sets: DataFrame, percent: int, block: int, chunk: int, also=None) -> DataFrame:
    """Pairs (a, b) of members (place, sid, label) of one place but different
    components that sizes and bitmaps allow to be linked.

    A place is cut into blocks of about ``block`` members; a task reads two of them at
    a time and holds ``chunk`` pairs against each other. ``also(columns, x, y)``
    may leave pairs to another place, by more columns of the members."""
    more = [c for c in members.columns if c not in ("place", "sid", "label")]
    brief = F.when(F.octet_length("bits") * 8 <= GROUP_BITS, F.col("bits"))
    known = written(members.select("sid").distinct().join(sets.select("sid", "size", "bits"), "sid")
                    .select("sid", "size", brief.alias("bits"), F.when(brief.isNull(), F.col("bits")).alias("long")))
    known = known.mapInArrow(_brief, "sid long, size long, bits binary")
    counts = members.groupBy("place").agg(F.count("*").alias("n"))
    blocks = F.greatest(F.ceil(F.col("n") / block).cast("long"), F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("sid"), blocks)
    ends = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j")))
    spread = members.join(counts, "place").select("place", "sid", "label", *more, own.alias("own"), F.explode(ends).alias("at"))
    rows = (spread.join(known, "sid").select("place", "at.i", "at.j", "own", "sid", "label", "size", "bits", *more)
            .repartition("place", "i", "j").sortWithinPartitions("place", "i", "j"))

    def listed(table: pa.Table) -> pa.RecordBatch:
        n = {c: table.column(c).to_numpy() for c in ("place", "i", "j", "own", "sid", "label", "size")}
        extra = {c: table.column(c).to_pylist() for c in more}
        maps = Bitmaps(table.column("bits").to_pylist())
        new = np.r_[True, (n["place"][1:] != n["place"][:-1]) | (n["i"][1:] != n["i"][:-1]) | (n["j"][1:] != n["j"][:-1])]
        begin = np.flatnonzero(new)
        sizes = np.diff(np.r_[begin, len(table)])
        work = np.cumsum(sizes * (sizes - 1) // 2)
        found, a = [np.empty((0, 2), dtype=np.int64)], 0
        while a < len(begin):
            b = max(a + 1, int(np.searchsorted(work, (work[a - 1] if a else 0) + chunk, side="right")))
            x, y = pairs_within(begin[a:b], sizes[a:b])
            keep = (n["label"][x] != n["label"][y]) & ((n["i"][x] == n["j"][x]) | (n["own"][x] != n["own"][y]))
            x, y = x[keep], y[keep]
            if also is not None and len(x):
                keep = also(extra, x, y)
                x, y = x[keep], y[keep]
            keep = allowed(x, y, n["size"], maps, percent)
            p, q = n["sid"][x[keep]], n["sid"][y[keep]]
            found.append(np.unique(np.stack([np.maximum(p, q), np.minimum(p, q)], axis=1), axis=0))
            a = b
        both = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def batches(it):
        held: list[pa.RecordBatch] = []
        for batch in it:
            held.append(batch)
            if sum(map(len, held)) < 4 * block:
                continue
            table = pa.Table.from_batches(held)
            tail = np.ones(len(table), dtype=bool)
            for c in ("place", "i", "j"):
                numbers = table.column(c).to_numpy()
                tail &= numbers == numbers[-1]
            cut = int(np.argmax(tail))  # the last place may go on in the next batch
            if cut:
                yield listed(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if sum(map(len, held)):
            yield listed(pa.Table.from_batches(held))

    return rows.mapInArrow(batches, "a long, b long").distinct()


def _brief(it):
    """Bitmaps of at most ``GROUP_BITS``, so that rows of groups are bounded; a folded
    one still bounds from above, if less closely."""
    for batch in it:
        bits = batch.column("bits").to_pylist()
        for i, long in enumerate(batch.column("long").to_pylist()):
            if long is not None:
                bits[i] = folded(np.frombuffer(long, dtype=np.uint8).reshape(1, -1), GROUP_BITS).tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("sid"), batch.column("size"), pa.array(bits, pa.binary())], names=["sid", "size", "bits"])
