"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

Finds which documents are linked by Jaccard similarity of their word-shingle
sets, and their connected components, without losing a link and without
comparing all pairs.

Tiles. Sets that link differ in few shingles: with similarity t and a smaller
set of s shingles, in at most (1-t)/t*s. Sizes are cut into bands; in a band
whose sets have at most U shingles, the hash space is cut into so many parts that
linked sets have more parts equal than a set leaves empty: some part is equal and
full. A tile holds the sets with the same band, part and part content (a set also
enters the band below when it may be the larger partner there). Empty parts make
no tile. A set that leaves too many parts empty (a matter of chance, for small sets)
also enters a tile for each of its first s - ceil(t*s) + 1 hashes, one of which any
two linked sets share; its linked partners without an equal full part do so too.
Below ``PARTS_FROM`` percent these prefix tiles are the only ones.

Checks. A pair of a tile is first held against its bitmaps (hashed, their length
grows with the set): a bit of one that the other lacks is a shingle that it
lacks, which bounds the intersection from above. What passes is decided by the
exact intersection of the sorted hash arrays.

Plan. (1) One pass over the texts writes size, digest, bitmap and tile keys per
document; equal sets share a digest and are one node from here on. (2) In the
tiles of the first few parts every set is checked against one pivot of the tile
(as many checks as rows), the likeliest of its pivots, and the links' components are
found. A tile's pivot is the set whose tiles hold most sets, as those of a text do
that others were copied from. (3) For all tiles the least and the largest component are aggregated; tiles
within one component are done. Linked sets share at least ``share`` tiles of a band
(as many equal parts as a set cannot leave empty), so sets with fewer open tiles
leave them, and the others need only the first of theirs: of n open tiles all but
share - 1. (4) What is left is checked against pivots again, then, in crowded tiles,
against sets picked by chance. Components are whole after each step, so no two sets that
links connect meet again. (5) In tiles that are open still, pairs of different components are held against their bitmaps
block by block, in blocks of bounded size and with bitmaps of bounded length, and
those that pass are decided. Tiles carry narrow rows until then. Copies and near copies in any number thus
cost as many checks as rows, and hot tiles are aggregated before they meet.

Hashes have 64 bits. Defined results: null, empty or blank texts have the empty
set, link with nothing and are their own component; repeated rows and equal
texts are linked, whatever their keys: rows with a null key are linked and link
others like any, only as a component's name null comes last. Texts of one key are
told apart by their marks. Only the key and text columns are used; ``keep_one``
gives all columns back as they are, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.llm.bitmaps import against_one, any_one, bitmap, crossing, crowded, likeliest, open_pairs, pass_bitmaps
from scribal.llm.common import frees_tables, is_empty, keep_named, mark, need, one_of_equal, small, written
from scribal.llm.labelled import groups
from scribal.llm.links import components, exact_links, is_text, labelled, named, repeated_rows
from scribal.llm.shingles import Shingler, digests, mix, pair_hash, segment_sums

WIDTH = 4
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Upper sizes of the bands grow by this factor.
GROWTH = 1.5
#: Least percent for tiles of parts; sets of lower similarities differ in too much.
PARTS_FROM = 67
#: Parts whose tiles give the first links.
PROBES = 4
#: Sets of a tile that one task compares with each other at a time.
BLOCK = 512
#: Pairs that are compared at a time.
CHUNK = 1 << 20
_PREFIX = np.uint64(0xFEED0123456789AB)


@lru_cache(maxsize=64)
def bands(percent: int = PERCENT, largest: int = 1 << 40) -> list[tuple[int, int, int]]:
    """(largest size, parts, parts in which linked sets may differ) of every band,
    ascending. Of the parts, those that a set fills as a rule outnumber those in
    which it may differ by a margin."""
    out, upper = [], 4
    while not out or out[-1][0] < largest:
        differ = (100 - percent) * upper // percent
        parts, margin = 0, 1 + max(2.0, 0.03 * upper)
        if differ and percent >= PARTS_FROM:
            parts = differ + 1
            while parts * (1 - exp(-upper / parts)) < differ + margin and parts < 4 * upper:
                parts += max(1, parts // 64)
        out.append((upper, parts, differ))
        upper = int(upper * GROWTH) + 1
    return out


def tile_keys(values: np.ndarray, counts: np.ndarray, percent: int) -> list[tuple[np.ndarray, ...]]:
    """For the own band, the one below and the prefix: (owner, part, key) of every
    tile that each set enters, and how many tiles each set shares at least with
    every set that it is linked with."""
    table = bands(percent, int(counts.max()) if len(counts) else 1)
    uppers, parts, differ = (np.array(x, dtype=np.int64) for x in zip(*table))
    own = np.searchsorted(uppers, counts, side="left")
    owner = np.repeat(np.arange(len(counts)), counts)
    spread = mix(values + np.uint64(1))
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    out, lacking = [], np.zeros(len(counts), dtype=bool)
    for below in (0, 1):
        band = np.maximum(own - below, 0)
        enters = (counts > 0) & (own >= below)
        if below:  # some smaller set of the band below may reach this size
            enters &= (percent * counts + 99) // 100 <= uppers[band]
        n_parts = np.where(enters, parts[band], 0)
        use = n_parts[owner] > 0
        of = owner[use]
        part = (((values[use] >> np.uint64(32)) * n_parts[of].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (part[1:] != part[:-1])]) if len(of) else of
        owner_at, part_at = of[starts], part[starts]
        at = (band[owner_at].astype(np.uint64) << np.uint64(40)) | part_at.astype(np.uint64)
        key = pair_hash(segment_sums(spread[use], starts), at)
        share = np.bincount(owner_at, minlength=len(counts)) - differ[band]
        lacking |= enters & (differ[band] > 0) & (share < 1)
        out.append((owner_at, part_at, key.view(np.int64), np.maximum(share, 1)))
    length = counts - (percent * counts + 99) // 100 + 1
    use = lacking[owner] & (place < length[owner])
    out.append((owner[use], place[use], pair_hash(values[use], _PREFIX).view(np.int64), np.ones(len(counts), dtype=np.int64)))
    return out


def describe(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """One row per document: key, size, digest, bitmap, probe and tile keys; the
    first ``own`` tiles are of the own band, the next ``below`` of the one below,
    the rest of the prefix; ``share_0`` and ``share_1`` say how many of each of the
    bands' tiles linked sets share."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), mark(F.col(text)).alias("mark"))
    numbers = T.ArrayType(T.LongType(), False)
    schema = T.StructType([
        rows.schema["key"], rows.schema["mark"], T.StructField("size", T.LongType(), False),
        T.StructField("sid", T.LongType(), False), T.StructField("bits", T.BinaryType(), False),
        T.StructField("probes", numbers, False), T.StructField("tiles", numbers, False),
        *(T.StructField(c, T.IntegerType(), False) for c in ("own", "below", "share_0", "share_1"))])

    def lists(owner: np.ndarray, keys: np.ndarray, n: int) -> pa.ListArray:
        order = np.argsort(owner, kind="stable")
        upto = np.r_[0, np.cumsum(np.bincount(owner, minlength=n))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(upto), pa.array(keys[order]))

    def batches(it):
        shingler = Shingler(width)
        for whole in it:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                texts = [(t or "").encode("utf-8") for t in batch.column(1).to_pylist()]
                for a, b in groups(texts, 1_000_000):
                    values, counts = shingler.sets(texts[a:b])
                    ends = np.cumsum(counts)
                    tiles = tile_keys(values, counts, percent)
                    owner, part, keys = (np.concatenate([x[k] for x in tiles]) for k in range(3))
                    probe = part < PROBES
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(counts.astype(np.int64)),
                        pa.array(digests(values, counts)),
                        pa.array([bitmap(values[e - c:e]) for e, c in zip(ends, counts)], pa.binary()),
                        lists(owner[probe], keys[probe], b - a), lists(owner, keys, b - a),
                        *(pa.array(np.bincount(x[0], minlength=b - a).astype(np.int32)) for x in tiles[:2]),
                        *(pa.array(x[3].astype(np.int32)) for x in tiles[:2])], names=schema.names)

    return rows.mapInArrow(batches, schema)


def open_members(once: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (place, sid, label, kind, share) of the tiles that hold several
    components: see ``still_open``."""
    tagged = labelled(once, labels)
    found = crossing(tagged.select("label", F.explode("tiles").alias("place")))
    entered = tagged.select("sid", "own", "below", "share_0", "share_1", "label", F.posexplode("tiles").alias("at", "place"))
    kind = F.when(F.col("at") < F.col("own"), 0).when(F.col("at") < F.col("own") + F.col("below"), 1).otherwise(2)
    share = F.when(kind == 0, F.col("share_0")).when(kind == 1, F.col("share_1")).otherwise(1)
    return still_open(written(entered.join(small(found), "place").select("place", "sid", "label", kind.alias("kind"), share.alias("share"))), 2)


def still_open(members: DataFrame, rounds: int = 1) -> DataFrame:
    """The members of tiles with several components that are in as many such tiles
    as they would share with a linked set; whoever leaves may close tiles for others."""
    for _ in range(rounds):
        members = written(members.join(small(crossing(members)), "place"))
        often = members.groupBy("sid", "kind").agg(F.count("*").alias("n_open"))
        members = written(members.join(often, ["sid", "kind"]).where("n_open >= share").drop("n_open"))
    return written(members.join(small(crossing(members)), "place"))


def needed(members: DataFrame) -> DataFrame:
    """``(sid, label, place)``: of the n open tiles of a set the first n - share + 1;
    sets that share as many as said share one of these."""
    listed = members.groupBy("sid", "label", "kind", "share").agg(F.sort_array(F.collect_list("place")).alias("tiles"))  # a set's own tiles
    first = F.expr("slice(tiles, 1, greatest(0, size(tiles) - share + 1))")
    return written(listed.select("sid", "label", F.explode(first).alias("place")).distinct())


def _popular(members: DataFrame) -> DataFrame:
    """``members`` with ``known``: how many sets the tiles of each set hold in all."""
    counts = members.groupBy("place").agg(F.count("*").alias("n"))
    known = members.join(small(written(counts.where("n > 1"))), "place").groupBy("sid").agg(F.sum("n").alias("known"))
    return written(members.join(known, "sid"))


@frees_tables
def component_rows(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """``(key, mark, size, label, name)`` of every document: mark tells texts of
    one key apart, label is the component, name its least key."""
    need(docs, [key, text])
    if not 1 <= percent <= 100:
        raise ValueError("percent is a number from 1 to 100")
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), mark(F.col(text)).alias("mark"))
    described = written(describe(docs, key, text, width, percent))
    # one node per distinct set, standing for its least document, those without a key last
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark")).alias("least")
    nodes = written(described.where("size > 0").groupBy("sid").agg(least).select("sid", "least.key", "least.mark"))
    many = repeated_rows(described, nodes)
    texts = one_of_equal(plain, many, is_text(), ["key", "mark"])
    standing = small(nodes.select(F.col("sid").alias("_sid"), F.col("key").alias("_key"), F.col("mark").alias("_mark")), of=nodes)
    once = one_of_equal(described.where("size > 0").join(standing, (F.col("sid") == F.col("_sid")) & is_text(), "left_semi"),
                        many, is_text(), ["key", "mark"]).drop("key", "mark")
    sets = once.select("sid", "size", "bits")

    def verified(pairs: DataFrame) -> DataFrame:
        return written(exact_links(written(pairs), nodes, texts, width, percent))

    probes = written(once.select("sid", F.explode("probes").alias("place"), F.col("sid").alias("label")))
    links = verified(against_one(_popular(probes), likeliest(), sets, percent))
    members = open_members(once, components(links))
    for pick, asked in ((likeliest(), _popular), (any_one(), crowded)):
        if is_empty(members):
            break
        found = verified(against_one(asked(needed(members)), pick, sets, percent))
        if is_empty(found):
            continue
        links = written(links.unionByName(found))
        members = still_open(labelled(members.drop("label"), components(links)))
    if not is_empty(members):
        pairs = written(open_pairs(needed(members), sets, percent, BLOCK, CHUNK))
        links = written(links.unionByName(verified(pass_bitmaps(pairs, sets, percent).select("a", "b"))))
    return named(described, nodes, components(links))


def join_ngrams(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                percent: int = PERCENT) -> DataFrame:
    """``(key, n_shingles, component_id)`` of every document."""
    return component_rows(docs, key, text, width, percent).select(
        F.col("key").alias(key), F.col("size").alias("n_shingles"), F.col("name").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
             percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of every component: that of the least key, of
    several texts under it the one with the least hash, of equal rows one.
    Documents without words are linked with nothing and all stay."""
    return keep_named(docs, component_rows(docs, key, text, width, percent), key, text)
