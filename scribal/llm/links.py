"""Links between texts with similar shingle sets: exact test, components, names.

Pieces shared by the joins that find candidate pairs in their own ways. A node is
a distinct non-empty set (``sid``, the digest of its sorted hashes) and stands for
its least document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribal.llm.common import is_empty, small, written
from scribal.llm.labelled import groups
from scribal.llm.shingles import Shingler, digests

#: Partners of a set that one task holds it against at a time.
BLOCK = 512


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted arrays of distinct hashes."""
    if not len(a) or not len(b):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def is_text(key: str = "_key", of_mark: str = "_mark"):
    """The condition that a row of (key, mark) is the one named by two columns."""
    return F.col("key").eqNullSafe(F.col(key)) & (F.col("mark") == F.col(of_mark))


def repeated_rows(described: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(_key, _mark)`` of the nodes for which several equal rows stand."""
    standing = small(nodes.select(F.col("sid").alias("_sid"), F.col("key").alias("_key"), F.col("mark").alias("_mark")), of=nodes)
    found = described.select("sid", "key", "mark").join(standing, (F.col("sid") == F.col("_sid")) & is_text())
    return written(found.groupBy("_sid").agg(F.count("*").alias("n"), F.first("_key").alias("_key"), F.first("_mark").alias("_mark"))
                   .where("n > 1").select("_key", "_mark"))


def exact_links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked. Pairs are dealt by b and, when b
    has many partners, a block of them, so tasks hold one set of b at a time."""
    if is_empty(pairs):
        return pairs.select("a", "b")
    counts = pairs.groupBy("b").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    members = pairs.join(counts, "b").select(
        F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), blocks).alias("block"), F.lit(1).alias("role"), F.col("a").alias("sid"))
    hubs = members.select("hub", "block").distinct().select("hub", "block", F.lit(0).alias("role"), F.col("hub").alias("sid"))
    asked = members.unionByName(hubs).join(nodes.select("sid", F.col("key").alias("_key"), F.col("mark").alias("_mark")), "sid")
    texts = docs.join(small(written(asked)), is_text())
    dealt = (texts.select("hub", "block", "role", "sid", "text").repartition(F.col("hub"), F.col("block"))
             .sortWithinPartitions("hub", "block", "role", "sid"))

    def batches(it):
        shingler, hub, of = Shingler(width), None, None
        for batch in (whole.slice(at, 1000) for whole in it for at in range(0, len(whole), 1000)):
            d = batch.to_pydict()
            texts = [(t or "").encode("utf-8") for t in d["text"]]
            out: tuple[list[int], list[int]] = ([], [])
            for a, b in groups(texts, 1_000_000):
                values, sizes = shingler.sets(texts[a:b])
                ends, marks = np.cumsum(sizes), digests(values, sizes)
                for i in range(b - a):
                    j = a + i
                    if marks[i] != d["sid"][j]:
                        continue  # another text with the same mark
                    mine = values[ends[i] - sizes[i]:ends[i]]
                    if d["role"][j] == 0:
                        hub, of = mine.copy(), d["hub"][j]
                    elif of == d["hub"][j] and linked(mine, hub, percent):
                        out[0].append(d["sid"][j])
                        out[1].append(of)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    return dealt.mapInArrow(batches, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(sid, label)`` for every node of the links: the least node that it is
    connected with. Labels spread over links and along labels until they stay, as
    whoever compares nodes of different labels would compare nodes of a component
    that is not whole with each other, by the square of its size."""
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("sid")).agg(F.min("b").alias("near"))
                     .select("sid", F.least("sid", "near").alias("label")))
    while not is_empty(labels):
        known = small(labels.select(F.col("sid").alias("_sid"), F.col("label").alias("_label")), of=labels)
        # the least label of a node and its neighbours, then of the node that this names
        near = both.join(known, F.col("b") == F.col("_sid")).select(F.col("a").alias("sid"), "_label", F.lit(None).cast("long").alias("own"))
        least = near.unionByName(labels.select("sid", F.col("label").alias("_label"), F.col("label").alias("own"))).groupBy("sid").agg(
            F.min("_label").alias("next"), F.max("own").alias("was"))
        step = written(least.join(known, F.col("next") == F.col("_sid")).select("sid", F.least("next", "_label").alias("label"), "was"))
        labels = step.select("sid", "label")
        labels._written = step._written
        if step.where("label < was").isEmpty():
            break
    return labels


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of their node; a node without links is its own."""
    return rows.join(small(labels), "sid", "left").withColumn("label", F.coalesce("label", "sid"))


def named(described: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, mark, size, label, name)`` of every document: its component and the
    component's least key. Only components of several nodes are looked up: their
    names meet nodes, not documents, so a hot component or text is split."""
    of_nodes = nodes.join(small(labels), "sid").select("sid", "label", "key")
    names = written(of_nodes.groupBy("label").agg(F.min("key").alias("name")))
    known = written(of_nodes.select("sid", "label").join(small(names), "label"))
    alone = nodes.join(small(labels.select("sid"), of=labels), "sid", "left_anti").select("sid", F.col("sid").alias("label"), F.col("key").alias("name"))
    sets = described.select("key", "mark", "size", "sid")
    full = sets.where("size > 0").join(small(written(known.select("sid", "label", "name").unionByName(alone))), "sid")
    empty = sets.where("size = 0").select("key", "mark", "size", F.col("sid").alias("label"), F.col("key").alias("name"))
    return full.select("key", "mark", "size", "label", "name").unionByName(empty)
