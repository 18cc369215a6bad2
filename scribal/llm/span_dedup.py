"""Substring dedup: sliding sentence spans, joined globally.

A text is cut into sentences by its words alone: after every word that ends in a
sentence mark or comma, and, of every ``WINDOW`` words in a row without such a word,
after the one with the least hash (of equal ones the last). White space and what
stands farther off play no part, so sentences have at most ``WINDOW`` words, and of
a run of ``2 * WINDOW + LEAST_WORDS`` = 50 words or more, wherever it stands, the
sentences from the cut that its first window picks to the one that its last window
picks are the same; these cuts are at least 50 + 1 - 2 * ``WINDOW`` words apart.
From every sentence on, the shortest run of ``LEAST_SENTENCES`` sentences or
more with ``LEAST_WORDS`` words or more is a span; its words, in lower case, are
hashed. So a shared run of 50 words holds a shared span. The first row with a span
(by key, then by the text's mark, then by place) keeps it; wherever else it occurs,
its sentences are removed, also from texts that only share a part.

Spans are written once and aggregated by hash to the least key and the least and
largest row (combined before the shuffle, so a passage that a third of all documents
share is no hot key); the repeated ones are picked out by a join, hot hashes apart,
and grouped by row.

Defined results: null texts stay null and have no sentences; a text without a
span long enough stays as it is; a row is its key and its text, so different texts
under one key, or without a key, are documents of their own, while equal rows are
one document and no repeats of each other; a repeat within one text is one; a null
key comes last and stands in ``kept_by`` as null; empty tables give empty results.
Other columns are kept by ``remove_repeats``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.llm.common import mark, need, small, unused, written
from scribal.llm.shingles import mix

LEAST_SENTENCES = 2
LEAST_WORDS = 20
#: Of so many words in a row one at least ends a sentence.
WINDOW = 15
#: A hash is hot from this share of all spans on (one part in so many).
HOT_PARTS = 4096
_END = re.compile(r"[.!?;:,]+[\"'»”)\]]*\s+")
_MARKED = re.compile(r"[.!?;:,][\"'»”)\]]*$")
_WORD = re.compile(r"\S+\s*")
_SEED = 1
_BASE = 0x9E3779B97F4A7C15


def _picked(words: list[str]) -> list[int]:
    """Of every ``WINDOW`` words in a row the one with the least hash, of equal ones the last."""
    hashes = [xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), _SEED) for w in words]
    out, at = [], -1
    for last in range(WINDOW - 1, len(hashes)):
        if at > last - WINDOW:  # still in the window
            if hashes[last] > hashes[at]:
                continue
            at = last
        else:
            begin = last - WINDOW + 1
            at = last - min(range(WINDOW), key=hashes[begin:last + 1][::-1].__getitem__)
        out.append(at)
    return out


def sentence_ends(text: str) -> list[int]:
    """Where each sentence ends, white space after it included."""
    ends, begin = [], 0
    for end in [m.end() for m in _END.finditer(text)] + [len(text)]:
        if end - begin >= 2 * WINDOW - 1:  # long enough to hold WINDOW words
            words = text[begin:end].lower().split()
            if words and _MARKED.search(words[-1]):  # else the text's last
                words.pop()
            if len(words) >= WINDOW:
                after = [w.end() for w in _WORD.finditer(text, begin, end)]
                ends += [after[i] for i in _picked(words) if after[i] < end]
        if end > begin:
            ends.append(end)
        begin = end
    return ends


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(n + 1, np.uint64(base))
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, sentence after the last) of every span."""
    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    ends = sentence_ends(text)
    if len(ends) < LEAST_SENTENCES:
        return none
    hashes, sizes, begin = [], [], 0
    for end in ends:
        words = text[begin:end].lower().split()
        hashes.append(xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")))
        sizes.append(len(words))
        begin = end
    n = len(ends)
    upto = np.r_[0, np.cumsum(sizes)]
    first = np.arange(n)
    after = np.maximum(np.searchsorted(upto, upto[:-1] + LEAST_WORDS), first + LEAST_SENTENCES)
    first, after = first[after <= n], after[after <= n]
    if not len(first):
        return none
    power, inverse = _powers(n)
    summed = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(np.array(hashes, dtype=np.uint64) * power[:n], out=summed[1:])
    value = (summed[after] - summed[first]) * inverse[first] + (after - first).astype(np.uint64) * np.uint64(_BASE)
    return mix(value), first, after


def all_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per span; ``again``: the text has had the same span before."""
    rows = docs.select(F.col(key).alias("doc"), mark(F.col(text)).alias("mark"), F.col(text).alias("text"))
    kinds = {"mark": T.LongType(), "hash": T.LongType(), "first": T.IntegerType(), "after": T.IntegerType(), "again": T.BooleanType()}
    schema = T.StructType([rows.schema["doc"], *(T.StructField(c, kind) for c, kind in kinds.items())])

    def batches(it):
        for batch in it:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                found = [spans(t or "") for t in part.column(2).to_pylist()]
                counts = np.array([len(h) for h, _, _ in found])
                again = []
                for h, _, _ in found:
                    repeat = np.ones(len(h), dtype=bool)
                    repeat[np.unique(h, return_index=True)[1]] = False
                    again.append(repeat)
                of = pa.array(np.repeat(np.arange(len(part)), counts))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(of), part.column(1).take(of),
                    pa.array(np.concatenate([h for h, _, _ in found]).view(np.int64)),
                    pa.array(np.concatenate([f for _, f, _ in found]).astype(np.int32)),
                    pa.array(np.concatenate([e for _, _, e in found]).astype(np.int32)),
                    pa.array(np.concatenate(again))], names=["doc", "mark", "hash", "first", "after", "again"])

    return rows.mapInArrow(batches, schema)


def _owned(rows: DataFrame, owners: DataFrame, total: int) -> DataFrame:
    """``rows`` whose hash has an owner, with it. Owners grow with the spans, so they
    meet by a shuffle at every size; those of hot hashes, fewer than ``HOT_PARTS``,
    are sent to all tasks, and their spans stay where they are."""
    is_hot = F.col("n") * HOT_PARTS > F.lit(total)
    hot = F.broadcast(owners.where(is_hot).drop("n"))
    cold = rows.join(hot, "hash", "left_anti").join(owners.where(~is_hot).drop("n").hint("merge"), "hash")
    return cold.unionByName(rows.join(hot, "hash"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, mark, first, after, kept_by)``: spans whose sentences are removed,
    of the row with that key and mark, and the key of the row that keeps them."""
    need(docs, [key, text])
    found = written(all_spans(docs, key, text))
    row = F.xxhash64("doc", "mark")
    owners = written(found.groupBy("hash").agg(F.min("doc").alias("kept_by"), F.min(row).alias("low"), F.max(row).alias("high"),
                                               F.count("*").alias("n")).where("low < high").select("hash", "kept_by", "n"))
    once = written(_owned(found.where("not again"), owners, found._written["rows"])
                   .select("doc", "mark", "hash", "first", "after", "kept_by"))
    # of several texts under the first key the one with the least mark keeps the span
    first_key = F.col("doc").eqNullSafe(F.col("kept_by"))
    several = written(once.where(first_key).groupBy("hash").agg(F.min("mark").alias("keeper"), F.max("mark").alias("_last"))
                      .where("keeper < _last").drop("_last"))
    out = ["doc", "mark", "first", "after", "kept_by"]
    others = once.where(~first_key).select(*out)
    beside = once.where(first_key).join(small(several), "hash").where("mark > keeper").select(*out)
    within = found.where("again").select("doc", "mark", "first", "after", F.col("doc").alias("kept_by"))
    return others.unionByName(beside).unionByName(within)


def _cut(text: str, first: list[int], after: list[int]) -> tuple[str, int, int]:
    """The text without the covered sentences, how many they are, and of how many."""
    ends = sentence_ends(text)
    gone = np.zeros(len(ends) + 1, dtype=np.int64)
    np.add.at(gone, first, 1)
    np.add.at(gone, after, -1)
    covered = np.cumsum(gone[:-1]) > 0
    begins = [0, *ends[:-1]]
    kept = "".join(text[b:e] for b, e, c in zip(begins, ends, covered.tolist()) if not c)
    return kept, int(covered.sum()), len(ends)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with their texts cut, and ``n_sentences``, ``n_removed`` and
    ``kept_by`` (keys of the documents that keep what was removed) as last columns;
    where the documents have columns of these names, under the next unused ones.
    Rows that lose nothing, most as a rule, are not shuffled."""
    n_sentences, n_removed, kept_by = unused(docs, "n_sentences", "n_removed", "kept_by")
    of, of_mark, spans_of, keepers, own = unused(docs, "_of", "_of_mark", "_spans", "_kept_by", "_own")
    owner = F.struct(F.col("kept_by").isNull().alias("none"), "kept_by")
    removal = written(repeated_spans(docs, key, text).groupBy(F.col("doc").alias(of), F.col("mark").alias(of_mark)).agg(
        F.collect_set(F.struct("first", "after")).alias(spans_of),  # equal rows have equal spans
        F.transform(F.sort_array(F.collect_set(owner)), lambda x: x["kept_by"]).alias(keepers)))
    columns = docs.columns
    marked = docs.withColumn(own, mark(F.col(text)))
    same = F.col(key).eqNullSafe(F.col(of)) & (F.col(own) == F.col(of_mark))
    losing = small(removal.select(of, of_mark))
    keys = T.ArrayType(docs.schema[key].dataType)
    # by a shuffle at every size: what is removed grows with the texts
    changed = marked.join(losing, same, "left_semi").join(removal.hint("merge"), same).select(*columns, spans_of, keepers)
    whole = marked.join(losing, same, "left_anti").select(
        *columns, F.lit(None).cast(removal.schema[spans_of].dataType).alias(spans_of), F.array().cast(keys).alias(keepers))
    shaped = changed.unionByName(whole)
    schema = T.StructType([*docs.schema.fields, T.StructField(n_sentences, T.LongType(), False),
                           T.StructField(n_removed, T.LongType(), False), T.StructField(kept_by, keys, False)])
    at = columns.index(text)

    def batches(it):
        for batch in it:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                texts, removed, total = [], [], []
                for t, s in zip(part.column(at).to_pylist(), part.column(len(columns)).to_pylist()):
                    if t is None or not s:
                        done = (t, 0, len(sentence_ends(t)) if t else 0)
                    else:
                        done = _cut(t, [x["first"] for x in s], [x["after"] for x in s])
                    for values, value in zip((texts, removed, total), done):
                        values.append(value)
                arrays = [pa.array(texts, pa.string()) if i == at else part.column(i) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), part.column(len(columns) + 1)],
                    names=schema.names)

    return shaped.mapInArrow(batches, schema)
