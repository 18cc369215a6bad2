"""MinHash near-duplicate removal with tensored banding.

Finds which documents are linked by Jaccard similarity of their word-shingle sets,
their connected components, and the one document of each that stays.

Signatures. A set is described by ``COLLECTIONS`` small collections of ``ROWS``
minhashes each. A table key combines a pair of collections, so ``C`` collections make
C (C - 1) / 2 tables, each on 2 * ROWS minhashes: the number of minhashes worked out
per shingle is about the square root of what as many independent tables take. Two sets
meet in some table when they agree in two collections; with similarity s they fail
to with probability (1 - p)^C + C p (1 - p)^(C - 1), p = s^ROWS: at s = 0.8 one
pair in a million, at 0.85 one in a hundred million, and unrelated sets of similarity
0.05 meet four times in a million.

Plan. (1) One pass over the texts writes size, digest, collection keys and a hashed
bitmap per document; equal sets are one node from here on. (2) A collection's key that
only one node has can make no meeting: nodes keep the collections they share with
another, so unrelated documents, most as a rule, enter no table at all. (3) In the
tables of the first few collections each node is held against its bucket's pivot (as
many checks as nodes), pairs are verified on the full sets, and the links' components
are found. The pivot is the node whose collection keys most nodes share: as a copy's
minhashes are mostly those of the text it was made from, that is this text. (4) For
all tables the least and the largest component of each bucket are aggregated; buckets
within one component are done. From here on nodes meet by the single collections of their
open buckets, at most 24 rows a node. (5) What is left is held against pivots again, then, where
it is crowded, against nodes picked by chance; components are whole after each step, so
no two nodes that links connect meet again. (6) Nodes of different
components that share two collections are compared in blocks of bounded size, each
pair in the first that it shares: bit counts of the bitmaps bound what two
sets can share, and only pairs that may be similar enough leave the task. Every link
that counts passes the exact test on the full sets. Copies and near copies in any
number thus cost as many checks as rows, and nothing is capped.

Defined results: null, empty or blank texts have the empty set, are linked with
nothing, are their own component and stay. Texts of fewer words than a shingle are
one shingle. Equal texts are linked whatever their keys; rows with a null key are
linked like any, only as a component's name null comes last. Repeated rows get equal
results in ``near_duplicates``; ``keep_one`` leaves one of them. An empty table gives
no rows. Only the key and text columns are used; other columns, whatever their
names, come back unchanged from ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.llm.bitmaps import against_one, any_one, bitmap, crossing, crowded, likeliest, open_pairs, pass_bitmaps
from scribal.llm.common import frees_tables, is_empty, keep_named, mark, need, one_of_equal, small, written
from scribal.llm.labelled import groups
from scribal.llm.links import components, exact_links, is_text, labelled, named, repeated_rows
from scribal.llm.shingles import Shingler, digests, pair_hash

WIDTH = 2
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
COLLECTIONS, ROWS = 24, 3
#: Collections whose tables give the first links.
PROBES = 5
#: Nodes of a bucket that one task compares with each other at a time.
BLOCK = 512
#: Pairs that are compared at a time.
CHUNK = 1 << 20

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 1 << 63, COLLECTIONS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, COLLECTIONS * ROWS, dtype=np.uint64)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The minhashes of every set, one row a set; of the empty set zeros."""
    out = np.zeros((len(counts), COLLECTIONS * ROWS), dtype=np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        for k in range(COLLECTIONS * ROWS):
            hashed = (((values ^ _SHIFTS[k]) * _FACTORS[k]) >> np.uint64(32)).astype(np.uint32)
            out[full, k] = np.minimum.reduceat(hashed, starts)
    return out


def collection_keys(sig: np.ndarray) -> np.ndarray:
    """One number per collection of a set, from its minhashes."""
    parts = sig.reshape(len(sig), COLLECTIONS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(COLLECTIONS, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = pair_hash(key, parts[:, :, r])
    return key.view(np.int64)


def describe(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``(key, mark, size, sid, halves, bits)`` of every document."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), mark(F.col(text)).alias("mark"))
    schema = T.StructType([rows.schema["key"], rows.schema["mark"], T.StructField("size", T.LongType(), False), T.StructField("sid", T.LongType(), False),
                           T.StructField("halves", T.ArrayType(T.LongType(), False), False), T.StructField("bits", T.BinaryType(), False)])

    def batches(it):
        shingler = Shingler(width)
        for batch in it:
            texts = [(t or "").encode("utf-8") for t in batch.column(1).to_pylist()]
            for a, b in groups(texts, 1_000_000):
                values, counts = shingler.sets(texts[a:b])
                ends = np.cumsum(counts)
                halves = pa.ListArray.from_arrays(pa.array((np.arange(b - a + 1) * COLLECTIONS).astype(np.int32)),
                                                  pa.array(collection_keys(signatures(values, counts)).ravel()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(counts.astype(np.int64)),
                    pa.array(digests(values, counts)), halves,
                    pa.array([bitmap(values[e - c:e]) for e, c in zip(ends, counts)], pa.binary())], names=schema.names)

    return rows.mapInArrow(batches, schema)


def shared_collections(nodes: DataFrame) -> DataFrame:
    """``(sid, known, shared)``: per node the collections ``(c, half)`` whose key
    another node has too, for nodes with two of them or more, and how many nodes
    these keys are shared with in all."""
    halves = nodes.select("sid", F.posexplode("halves").alias("c", "half"))
    common = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1")
    met = halves.join(small(written(common)), "half")
    listed = met.groupBy("sid").agg(F.sum("n").alias("known"), F.sort_array(F.collect_list(F.struct("c", "half"))).alias("shared"))
    return listed.where(F.size("shared") > 1)


def in_tables(shared: DataFrame, first: int = COLLECTIONS) -> DataFrame:
    """One row per table that a node is in: its other columns, ``t`` (the two
    collections) and ``place``, the bucket. Of the tables on the first collections
    only, if asked."""
    kept = F.filter("shared", lambda x: x["c"] < first)
    pairs = F.flatten(F.transform(kept, lambda x: F.transform(
        F.filter(kept, lambda y: y["c"] > x["c"]),
        lambda y: F.struct((x["c"] * COLLECTIONS + y["c"]).alias("t"), F.xxhash64(x["half"], y["half"], x["c"], y["c"]).alias("place")))))
    rest = [c for c in shared.columns if c != "shared"]
    return shared.select(*rest, F.explode(pairs).alias("_at")).select(*rest, "_at.t", "_at.place")


def in_collections(shared: DataFrame) -> DataFrame:
    """One row per collection that a node shares: its other columns, ``c`` and ``place``,
    the collection's key."""
    rest = [c for c in shared.columns if c != "shared"]
    return shared.select(*rest, F.explode("shared").alias("_h")).select(*rest, "_h.c", F.col("_h.half").alias("place"))


def still_open(members: DataFrame) -> DataFrame:
    return members.join(small(crossing(members)), "place")


def in_open_tables(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """``shared`` with the nodes, and of these the collections, that are in buckets of
    several components. A bucket can hold several only if both of its collections' keys
    do, so tables are formed of these keys only. The rows by tables, up to
    COLLECTIONS - 1 times those by collections, stay in here."""
    met = still_open(in_collections(labelled(shared, labels))).groupBy("sid", "label").agg(
        F.sort_array(F.collect_list(F.struct("c", F.col("place").alias("half")))).alias("shared"))
    tables = still_open(written(in_tables(met.where(F.size("shared") > 1))))
    both = F.explode(F.array((F.col("t") / COLLECTIONS).cast("int"), (F.col("t") % COLLECTIONS).cast("int"))).alias("c")
    kept = tables.select("sid", both).groupBy("sid").agg(F.collect_set("c").alias("kept"))
    return written(shared.join(kept, "sid").select(
        "sid", "known", F.filter("shared", lambda h: F.array_contains("kept", h["c"])).alias("shared")))


def open_members(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (place, sid, label, known, c) of the collections whose key several
    components have: nodes that meet in an open table meet there too, in far fewer
    places. Labels meet nodes, not their rows."""
    return written(still_open(in_collections(labelled(shared, labels))))


def meet_here_first(columns: dict, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs share two collections or more, of which this is the first."""
    code = np.array(columns["halves"], dtype=np.int64).reshape(-1, COLLECTIONS)
    here = np.array(columns["c"], dtype=np.int64)
    out = np.zeros(len(x), dtype=bool)
    for at in range(0, len(x), CHUNK // 8):
        p, q = x[at:at + CHUNK // 8], y[at:at + CHUNK // 8]
        same = code[p] == code[q]
        out[at:at + len(p)] = (same.argmax(axis=1) == here[p]) & (same.sum(axis=1) > 1)
    return out


@frees_tables
def component_rows(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """``(key, mark, size, label, name)`` of every document: mark tells texts of
    one key apart, label is the component, name its least key."""
    need(docs, [key, text])
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), mark(F.col(text)).alias("mark"))
    described = written(describe(docs, key, text, width))
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark")).alias("least")
    nodes = written(described.where("size > 0").groupBy("sid").agg(
        least, *[F.first(c).alias(c) for c in ("size", "halves", "bits")]).select("sid", "least.key", "least.mark", "size", "halves", "bits"))
    texts = one_of_equal(plain, repeated_rows(described, nodes), is_text(), ["key", "mark"])
    shared = written(shared_collections(nodes))

    def verified(pairs: DataFrame) -> DataFrame:
        return written(exact_links(written(pairs), nodes, texts, width, percent))

    members = written(in_tables(shared, PROBES).withColumn("label", F.col("sid")))
    links = verified(against_one(members, likeliest(), nodes, percent))
    labels = components(links)
    shared = in_open_tables(shared, labels)
    members = open_members(shared, labels)
    for pick, asked in ((likeliest(), None), (any_one(), crowded)):
        if is_empty(members):
            break
        found = verified(against_one(asked(members) if asked else members, pick, nodes, percent))
        if is_empty(found):
            continue
        links = written(links.unionByName(found))
        members = open_members(shared, components(links))
    if not is_empty(members):
        full = members.drop("known").join(nodes.select("sid", "halves"), "sid")
        pairs = open_pairs(full, nodes, percent, BLOCK, CHUNK, meet_here_first)
        links = written(links.unionByName(verified(pairs)))
    return named(described, nodes, components(links))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` of every document."""
    rows = component_rows(docs, key, text, width, percent)
    return rows.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), F.col("name").alias("component_id"),
                       F.col("key").eqNullSafe(F.col("name")).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of every component: that of the least key, of
    several texts under it the one with the least hash, of equal rows one.
    Documents without words are linked with nothing and all stay."""
    return keep_named(docs, component_rows(docs, key, text, width, percent), key, text)
