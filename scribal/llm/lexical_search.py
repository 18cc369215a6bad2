"""Ranked lexical search: the Best Position Algorithm over impact lists.

Every query item gets its ``k`` highest-scoring documents. A document's score is
the sum of its impacts over the item's terms; an impact is the term's weight
times a saturated, length-normalised count, all in whole numbers (``weight``,
``impacts``), so that ties are real ties.

Plan. (1) One pass over the texts keeps, per document, its number of terms and the
counts of the terms that some item asks for; that narrow table is written once.
(2) N, L and the document frequencies are aggregated over all documents. (3) The
narrow rows are dealt, as they lie, into shards of a bounded number of documents.
In a shard each term has an impact list, highest first, and every item runs the
Best Position Algorithm: lists are read to a depth that doubles; a document met for
the first time is scored by direct accesses to the other lists, which also mark its
positions there as seen; a list's best position is the end of its contiguous seen
positions, which may lie far beyond the depth read. No unseen document can score
more than the sum of the impacts at the best positions, so an item stops as soon as
that sum is strictly below its k-th score; at equality an unseen document might tie.
The k-th score is carried from shard to shard of a task, so later shards stop early
or are not entered. (4) The best k per item and task are ranked by one window, which
Spark limits per partition before its shuffle.

Items are a stated query set: they are taken in blocks of at most ``BLOCK_TERMS``
distinct terms and ``BLOCK_ITEMS`` items, each block in a pass of its own, so what
goes to the tasks is bounded whatever the number of items. Nothing of the documents
goes to the driver but the totals and one frequency per term of a block.

Defined results: terms are the maximal runs of ASCII letters, digits and all
characters beyond ASCII, A-Z lowered; null and empty texts have none, are no
documents in N and are never found, nor do items without terms find anything.
Only scores above 0 are listed; equal scores are ranked by ascending key, null
last. Repeated rows are documents of their own; of rows that share an item's key
each is an item of its own, with ranks of its own. Empty tables give no rows. Only
the key and text columns of both tables are used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.llm.common import need, written
from scribal.llm.labelled import groups

TOP = 10
#: Distinct terms and items of one block of the query set.
BLOCK_TERMS, BLOCK_ITEMS = 8192, 2000
#: Documents of a shard, and numbers of its table of terms by documents, at most.
SHARD_DOCS, SHARD_CELLS = 4096, 1 << 23
#: Positions that the first round reads from each list.
FIRST_DEPTH = 8
# every byte outside terms becomes a space, A-Z are lowered
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return (text or "").encode("utf-8").translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    """A term's weight from the number of documents and its document frequency."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """Impacts of counts in documents of the given lengths, as whole numbers."""
    m = 10 + 90 * lengths * n_docs // all_terms
    return weights * (1_000_000_000 * counts // (1000 * counts + 8 * m))


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[tuple[dict[bytes, int], list[tuple[object, list[int]]]]]:
    """Blocks of the query set: the number of each distinct term, and per item its
    key and term numbers. One block is held at a time."""
    index: dict[bytes, int] = {}
    block: list[tuple[object, list[int]]] = []
    for row in items.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator():
        asked = dict.fromkeys(terms(row["text"]))
        if not asked:
            continue
        if block and (len(block) >= BLOCK_ITEMS or len(index) + len(asked) > BLOCK_TERMS):
            yield index, block
            index, block = {}, []
        block.append((row["key"], [index.setdefault(t, len(index)) for t in asked]))
    if block:
        yield index, block


def count_terms(docs: DataFrame, key: str, text: str, index: dict[bytes, int]) -> DataFrame:
    """``(key, n, ids, tfs)`` of every document with a term: how many terms it
    has, and the numbers and counts of those in ``index``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    numbers = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([rows.schema["key"], T.StructField("n", T.LongType(), False),
                           T.StructField("ids", numbers, False), T.StructField("tfs", numbers, False)])
    width = max(1, len(index))

    def batches(it):
        get = index.get
        for batch in it:
            texts = batch.column(1).to_pylist()
            for a, b in groups([t or "" for t in texts]):
                found = [terms(t) for t in texts[a:b]]
                n = np.fromiter(map(len, found), dtype=np.int64, count=b - a)
                at = np.fromiter((get(t, -1) for ts in found for t in ts), dtype=np.int64, count=int(n.sum()))
                owner = np.repeat(np.arange(b - a), n)
                cell, tf = np.unique((owner * width + at)[at >= 0], return_counts=True)
                upto = pa.array(np.searchsorted(cell, np.arange(b - a + 1) * width).astype(np.int32))
                out = pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(n),
                    pa.ListArray.from_arrays(upto, pa.array((cell % width).astype(np.int32))),
                    pa.ListArray.from_arrays(upto, pa.array(tf.astype(np.int32)))], names=schema.names)
                yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(batches, schema)


class _Shard:
    """Impact lists of one shard: ``docs[at[t]:at[t + 1]]`` are the documents of
    term t by falling impact, ``impact`` runs beside it, ``cells`` is the table of
    terms by documents for direct accesses."""

    def __init__(self, ids: np.ndarray, owner: np.ndarray, impact: np.ndarray, n_terms: int, n_docs: int):
        order = np.lexsort((owner, -impact, ids))
        self.docs, self.impact = owner[order], impact[order]
        self.at = np.searchsorted(ids[order], np.arange(n_terms + 1))
        self.cells = np.zeros((n_terms, n_docs), dtype=np.int64)
        self.cells[ids, owner] = impact
        self.n_docs = n_docs

    def best(self, asked: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that may be among the best ``k`` of an item: all
        that score ``floor`` or more and the shard's own k-th score or more."""
        lists = [(self.docs[a:b], self.impact[a:b]) for a, b in zip(self.at[asked], self.at[asked + 1]) if b > a]
        best_at = np.zeros(len(lists), dtype=np.int64)  # contiguous seen positions of each list
        seen = np.zeros(self.n_docs, dtype=bool)
        found = [np.empty(0, dtype=np.int64)]
        scores = [np.empty(0, dtype=np.int64)]
        bar, depth = floor, FIRST_DEPTH
        bound = sum(int(impact[0]) for _, impact in lists)
        while bound > 0 and bound >= bar:
            met = np.unique(np.concatenate([docs[:depth] for docs, _ in lists]))
            met = met[~seen[met]]
            seen[met] = True
            found.append(met)
            scores.append(self.cells[asked[:, None], met].sum(axis=0))
            got = np.concatenate(scores)
            if len(got) >= k:
                bar = max(floor, int(np.partition(got, len(got) - k)[len(got) - k]))
            bound = 0
            for i, (docs, impact) in enumerate(lists):
                unseen = np.flatnonzero(~seen[docs[best_at[i]:]])
                if len(unseen):
                    best_at[i] += unseen[0]
                    bound += int(impact[best_at[i] - 1])
                else:
                    best_at[i] = len(docs)  # no unseen document holds the term
            depth *= 2
        docs, got = np.concatenate(found), np.concatenate(scores)
        keep = (got > 0) & (got >= bar)
        return docs[keep], got[keep]


def _order(entry: tuple[int, object]):
    return -entry[0], entry[1] is None, entry[1]


def best_of_tasks(counted: DataFrame, asked: list[list[int]], weights: np.ndarray, n_docs: int, all_terms: int, k: int) -> DataFrame:
    """``(item, key, score)``: the best ``k`` documents of each item among those
    of each task."""
    schema = T.StructType([T.StructField("item", T.IntegerType(), False), counted.schema["key"], T.StructField("score", T.LongType(), False)])
    size = max(1, min(SHARD_DOCS, SHARD_CELLS // max(1, len(weights))))
    queries = [np.array(a, dtype=np.int64) for a in asked]

    def shards(it):
        held, rows = [], 0
        for whole in it:
            for at in range(0, len(whole), size):
                part = whole.slice(at, size)
                if rows + len(part) > size:
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
                held.append(part)
                rows += len(part)
        if rows:
            yield pa.Table.from_batches(held)

    def batches(it):
        top: list[list[tuple[int, object]]] = [[] for _ in queries]
        for table in shards(it):
            table = table.combine_chunks()
            lists = table.column("ids").combine_chunks()
            per = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            owner = np.repeat(np.arange(len(per)), per)
            ids = lists.flatten().to_numpy().astype(np.int64)
            tfs = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            n = table.column("n").to_numpy()
            impact = impacts(weights[ids], tfs, n[owner], n_docs, all_terms)
            shard = _Shard(ids, owner, impact, len(weights), len(per))
            keys = table.column("key")
            for i, query in enumerate(queries):
                floor = top[i][-1][0] if len(top[i]) == k else 0
                docs, scores = shard.best(query, k, floor)
                if len(docs):
                    found = zip(scores.tolist(), keys.take(pa.array(docs)).to_pylist())
                    top[i] = sorted([*top[i], *found], key=_order)[:k]
        for i, entries in enumerate(top):
            if entries:
                scores, keys = zip(*entries)
                yield pa.RecordBatch.from_arrays([
                    pa.array([i] * len(entries), pa.int32()), pa.array(keys, key_type), pa.array(scores, pa.int64())], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(schema["key"].dataType)
    return counted.mapInArrow(batches, schema)


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", k: int = TOP) -> DataFrame:
    """``(item_key, rank, key, score)``: the best ``k`` documents of every item."""
    need(docs, [key, text])
    need(items, [item_key, item_text])
    if item_key in (key, "rank", "score") or key in ("rank", "score"):
        raise ValueError("the keys of items and documents need different names, other than rank and score")
    spark = docs.sparkSession
    out = None
    for index, block in _blocks(items, item_key, item_text):
        counted = written(count_terms(docs, key, text, index))
        totals = counted.agg(F.count("*").alias("n_docs"), F.sum("n").alias("all_terms")).first()
        df = np.zeros(len(index), dtype=np.int64)
        for row in counted.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # a row per term of the block
            df[row["id"]] = row["count"]
        weights = np.array([weight(totals["n_docs"], int(d)) for d in df], dtype=np.int64)
        best = best_of_tasks(counted, [a for _, a in block], weights, totals["n_docs"], totals["all_terms"] or 1, k)
        by_rank = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)],
                                      T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", items.schema[item_key].dataType)]))
        part = ranked.join(F.broadcast(names), "item").select(  # BLOCK_ITEMS rows at most
            F.col("name").alias(item_key), "rank", F.col("key").alias(key), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        empty = T.StructType([T.StructField(item_key, items.schema[item_key].dataType), T.StructField("rank", T.IntegerType()),
                              T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType())])
        out = spark.createDataFrame([], empty)
    return out
