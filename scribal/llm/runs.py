"""Periodic runs of words, found on an enhanced suffix array.

A run is a longest stretch of consecutive words with a smallest period q (words q
apart are equal), at least two periods and ``least`` words long. Its last square,
the one that ends where the run ends, is a branching tandem repeat: the suffixes at
its two halves agree in exactly q words.

Method. The suffixes of all words of a text are sorted by doubling (only groups
that are still tied are sorted again), which keeps the ranks by the first 1, 2, 4, ...
words; neighbours' common lengths (LCP) follow from these ranks. Every LCP interval
of depth q is split where its neighbours agree in q words only; suffixes on the two
sides agree in exactly q words. For each suffix i of the smaller side the inverse
suffix array tells whether i + q or i - q lies on the other side: if so, the pair
is a branching tandem repeat. Rotating it to the left as long as words agree (by
the ranks again, in steps of powers of two) gives the run; squares of several periods
in one run meet in the same start and end, and the least period stays. Intervals are
pairs of numbers found by one stack; no tree is built. The work is of order
n log n in the words of a text.

Texts are independent, so the job has no shuffle; many short texts are sorted in one
array (words of different texts count as different), of about ``CHARS`` characters.
A text longer than that is sorted alone: it needs some 100 bytes a word.

Defined results: words are the longest stretches without ASCII white space; null,
empty and blank texts have no words, no runs and collapse to the empty text.
Repeated rows and rows that share a key, null included, are texts of their own. Only
the key and text columns are used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.llm.common import need
from scribal.llm.labelled import groups

#: Words of the shortest run that counts.
LEAST = 12
#: Characters of the texts that are sorted in one array.
CHARS = 1_000_000
#: Suffixes whose partners are looked up at a time.
CHUNK = 1 << 20


def suffix_ranks(values: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... values; in the last all
    differ. A rank is the place of its first equal in sorted order; one entry more,
    -1, stands behind the end."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    first = np.flatnonzero(np.r_[True, values[order][1:] != values[order][:-1]]) if n else order
    sizes = np.diff(np.r_[first, n])
    rank = np.full(n + 1, -1, dtype=np.int32)
    rank[order] = np.repeat(first, sizes)
    levels, step = [rank], 1
    tied = order[np.repeat(sizes > 1, sizes)]
    while len(tied):
        key = rank[tied].astype(np.int64) * (n + 2) + rank[np.minimum(tied + step, n)] + 1
        by_key = np.argsort(key, kind="stable")
        tied, key = tied[by_key], key[by_key]
        old = rank[tied]
        at = np.arange(len(tied))
        new_old = np.r_[True, old[1:] != old[:-1]]
        new = np.r_[True, key[1:] != key[:-1]]
        begin_old = np.maximum.accumulate(np.where(new_old, at, 0))
        begin = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[tied] = old + begin - begin_old
        levels.append(rank)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(tied)])
        tied = tied[np.repeat(sizes > 1, sizes)]
        step *= 2
    return levels


def common_prefixes(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """For each place of the suffix array how many values its suffix and the one
    before agree in."""
    lcp = np.zeros(len(sa), dtype=np.int64)
    at = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    a, b = sa[at - 1].astype(np.int64), sa[at].astype(np.int64)
    for k in range(len(levels) - 2, -1, -1):
        same = levels[k][a] == levels[k][b]
        a, b = a + (same << k), b + (same << k)
    lcp[at] = b - sa[at]
    return lcp


def splits(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(low, mid, high, depth)``: the suffixes at places low to mid - 1 agree with
    those at mid to high - 1 in exactly ``depth`` values. Every two suffixes that
    agree in a value are parted by exactly one split."""
    wide = np.r_[lcp, 0]
    near = (wide > 0) | (np.r_[0, wide[:-1]] > 0) | (np.r_[wide[1:], 0] > 0)
    places = np.flatnonzero(near)
    low, mid, high, depth = [], [], [], []
    open_at: list[int] = []  # splits whose high end is not known
    base = 0
    for p, v in zip(places.tolist(), wide[places].tolist()):
        while open_at and depth[open_at[-1]] > v:
            high[open_at.pop()] = p
        if v == 0:
            base = p
            continue
        low.append(mid[open_at[-1]] if open_at else base)
        mid.append(p)
        high.append(0)
        open_at.append(len(mid) - 1)
        depth.append(v)
    return tuple(np.array(x, dtype=np.int64) for x in (low, mid, high, depth))


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, period)`` of every square whose halves' suffixes agree in exactly
    one period."""
    low, mid, high, depth = splits(lcp)
    left = mid - low <= high - mid  # the smaller side is looked through
    begin, size = np.where(left, low, mid), np.where(left, mid - low, high - mid)
    other, end = np.where(left, mid, low), np.where(left, high, mid)
    starts, periods = [], []
    upto = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CHUNK, side="right")))
        per = size[a:b]
        split = np.repeat(np.arange(a, b), per)
        place = np.arange(len(split)) - np.repeat(np.cumsum(per) - per, per) + begin[split]
        i, q = sa[place].astype(np.int64), depth[split]
        for j in (i + q, i - q):
            inside = (j >= 0) & (j < len(sa))
            at = isa[np.where(inside, j, 0)]
            hit = inside & (at >= other[split]) & (at < end[split])
            starts.append(np.minimum(i, j)[hit])
            periods.append(q[hit])
        a = b
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *periods])


def runs(values: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of the values, by start and period.
    Texts in one array must hold different values and end in one of their own."""
    levels = suffix_ranks(values)
    if len(levels) == 1:  # nothing occurs twice
        return np.empty((0, 3), dtype=np.int64)
    isa = levels[-1][:-1]
    sa = np.empty(len(values), dtype=np.int32)
    sa[isa] = np.arange(len(values), dtype=np.int32)
    begin, period = branching_squares(sa, isa, common_prefixes(sa, levels))
    end = begin + 2 * period
    for k in range(len(levels) - 2, -1, -1):  # rotate to the left while words agree
        before = begin - (1 << k)
        inside = np.maximum(before, 0)
        begin = np.where((before >= 0) & (levels[k][inside] == levels[k][inside + period]), before, begin)
    keep = end - begin >= least
    begin, end, period = begin[keep], end[keep], period[keep]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.r_[True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])] if len(begin) else keep[:0]
    begin, end, period = begin[first], end[first], period[first]
    order = np.lexsort((period, begin))
    return np.stack([begin, end - begin, period], axis=1)[order]


def _numbered(found: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers, different in each text, with a number of
    its own behind each text."""
    index: dict[bytes, int] = {}
    for words in found:
        for w in words:
            if w not in index:
                index[w] = len(index)
    width = len(index) + 1
    end = width - 1
    out = np.fromiter((x for words in found for x in (*map(index.__getitem__, words), end)), dtype=np.int64,
                      count=sum(map(len, found)) + len(found))
    return out + np.repeat(np.arange(len(found), dtype=np.int64) * width, [len(words) + 1 for words in found])


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``(key, runs, collapsed)`` of every row: its runs as (start, length, period),
    by start and period, and its words joined by one space without those that any
    run holds after its first period."""
    need(docs, [key, text])
    if key in ("runs", "collapsed"):
        raise ValueError("the key needs another name than runs and collapsed")
    rows = docs.select(F.col(key), F.col(text).alias("text" if key != "text" else "_text"))
    run = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
    schema = T.StructType([rows.schema[0], T.StructField("runs", T.ArrayType(run, False), False), T.StructField("collapsed", T.StringType(), False)])

    def batches(it):
        for batch in it:
            texts = [(t or "").encode("utf-8") for t in batch.column(1).to_pylist()]
            for a, b in groups(texts, CHARS):
                found = [t.split() for t in texts[a:b]]
                begins = np.cumsum([0, *(len(words) + 1 for words in found)])
                rows_found = runs(_numbered(found), least)
                owner = np.searchsorted(begins, rows_found[:, 0], side="right") - 1
                upto = np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32)
                change = np.zeros(begins[-1] + 1, dtype=np.int64)
                np.add.at(change, rows_found[:, 0] + rows_found[:, 2], 1)
                np.add.at(change, rows_found[:, 0] + rows_found[:, 1], -1)
                kept = np.cumsum(change) == 0
                collapsed = []
                for k, words in enumerate(found):
                    if upto[k + 1] > upto[k]:
                        words = [words[x] for x in np.flatnonzero(kept[begins[k]:begins[k + 1] - 1]).tolist()]
                    collapsed.append(b" ".join(words).decode("utf-8"))
                parts = [rows_found[:, 0] - begins[owner], rows_found[:, 1], rows_found[:, 2]]
                structs = pa.StructArray.from_arrays([pa.array(p) for p in parts], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(upto), structs), pa.array(collapsed, pa.string())],
                    names=schema.names)

    return rows.mapInArrow(batches, schema)
