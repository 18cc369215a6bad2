"""Bounded labelled samples and token tables for the trained operators."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(key: str = "doc_id") -> Column:
    """True for the fold that no model learns from (a null key is in it)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], max_chars: int,
                    key: str = "doc_id", text: str = "text") -> list[tuple[str, int]]:
    """Texts and labels for training, at most ``per_class[l]`` of label l.

    Rows are drawn by the digest of their key among the labelled rows outside
    the held-out fold whose text has 1 to ``max_chars`` characters. The sample
    is bounded, so its keys may be broadcast and its texts come to the driver.
    """
    usable = labels.where(F.col(label).isin(*per_class) & ~held_out(key) & F.col(key).isNotNull())
    usable = usable.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    drawn = None
    for value, most in per_class.items():
        part = usable.where(F.col("_label") == value).orderBy(F.md5(F.col("_key").cast("string")), "_key").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    fit = docs.where(F.length(text).between(1, max_chars)).select(F.col(key).alias("_doc"), F.col(text).alias("_text"))
    rows = fit.join(F.broadcast(drawn), F.col("_doc") == F.col("_key")).select("_doc", "_text", "_label")
    found = rows.limit(2 * sum(per_class.values())).collect()  # repeated rows must not grow the sample
    return [(t, y) for _, t, y in sorted((r["_doc"], r["_text"], r["_label"]) for r in found)]


class TokenTable:
    """Values of tokens, worked out once per distinct token and kept for a
    bounded number of them."""

    def __init__(self, pattern: re.Pattern, values: Callable[[list[str]], np.ndarray], keep: int = 300_000):
        self.find, self.values, self.keep = pattern.findall, values, keep
        self.index: dict[str, int] = {}
        self.known = values([])

    def lookup(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Values of all tokens of all texts, and the number per text."""
        found = [self.find(t) for t in texts]
        if len(self.index) > self.keep:
            self.index, self.known = {}, self.known[:0]
        new = [w for w in dict.fromkeys(w for ws in found for w in ws) if w not in self.index]
        if new:
            base = len(self.index)
            self.index.update(zip(new, range(base, base + len(new))))
            self.known = np.concatenate([self.known, self.values(new)])
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        get = self.index.__getitem__
        at = np.fromiter((i for ws in found for i in map(get, ws)), dtype=np.int64, count=int(counts.sum()))
        return self.known[at], counts


def groups(texts: list[str], chars: int = 1_000_000):
    """Stretches of texts of about ``chars`` characters; one text at least."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)
