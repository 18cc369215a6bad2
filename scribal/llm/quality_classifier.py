"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

A text's features are the hashes of its runs of one, two and three tokens
(words and runs of marks, case kept), each weighing its share of all of them,
plus hashed marks for the share of its three-token runs that are distinct and
for the share of its words that repeat one of the two tokens before.
The weights are trained on a bounded labelled sample (``PER_CLASS`` rows per
label, ``MAX_CHARS`` characters each) by follow-the-regularised-leader updates
in a fixed order, and are sparse; scoring is one sparse dot product per text,
over whole texts, in Arrow batches.

Defined results: a null or token-free text scores the model's score of no
features; without any labelled row every score is 0.5; repeated rows get equal
scores. Labels, language, source and key are not features.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scribal.llm.common import need
from scribal.llm.labelled import TokenTable, groups, labelled_sample

BITS = 20
ORDERS = 3
#: The shares of a text's n-grams sum up to this per order.
SCALE = 8.0
#: Sample bound: rows per label and characters per row.
PER_CLASS = {0: 4000, 1: 8000}
MAX_CHARS = 20_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: FTRL-proximal: learning rate, its smoothing, L1 and L2 penalties, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.1, 4
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass
class Model:
    """Sparse weights: bucket numbers in order, their weights, the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.buckets] = self.weights
        return out


def _hashes(tokens: list[str]) -> np.ndarray:
    raw = [t.encode("utf-8", "surrogatepass") for t in tokens]
    low = np.fromiter((zlib.crc32(b) for b in raw), dtype=np.uint64, count=len(raw))
    high = np.fromiter((zlib.crc32(b, 0x5BD1E995) for b in raw), dtype=np.uint64, count=len(raw))
    # the lowest bit tells words from marks
    word = np.fromiter((t[0].isalnum() or t[0] == "_" for t in tokens), dtype=np.uint64, count=len(raw))
    return (low & ~np.uint64(1)) | word | (high << np.uint64(32))


def token_table() -> TokenTable:
    return TokenTable(TOKEN, _hashes)


def ngram_buckets(hashes: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per order: 64-bit n-gram hashes, their buckets, the text of each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    out = []
    mixed = np.zeros(len(hashes), dtype=np.uint64)
    for n in range(ORDERS):
        # hash of the run that begins here, one token longer than before
        size = max(0, len(hashes) - n)
        mixed = mixed[:size] * np.uint64(_ODD[2]) + hashes[n:n + size]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_ODD[0])
        inside = owner[:size] == owner[n:n + size]
        whole, of = mixed[inside], owner[:size][inside]
        bucket = ((whole * np.uint64(_ODD[1])) >> np.uint64(64 - BITS)).astype(np.int64)
        out.append((whole, bucket, of))
    return out


def _mark(name: str, share: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Bucket of the mark of each text's share of its total, in tenths."""
    tenths = np.where(total > 0, (10 * share) // np.maximum(total, 1), 11)
    names = _hashes([f"{name}={k}" for k in range(12)])
    return ((names * np.uint64(_ODD[1])) >> np.uint64(64 - BITS)).astype(np.int64)[tenths]


def _distinct(whole: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
    """How many different runs each text has."""
    order = np.lexsort((whole, of))
    w, o = whole[order], of[order]
    new = np.r_[True, (w[1:] != w[:-1]) | (o[1:] != o[:-1])] if len(w) else np.zeros(0, bool)
    return np.bincount(o[new], minlength=n_texts)


def _echoes(hashes: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Words equal to one of the two tokens before them, and all words."""
    word = (hashes & np.uint64(1)) == 1
    echo = np.zeros(len(hashes), dtype=bool)
    for back in (1, 2):
        echo[back:] |= (hashes[back:] == hashes[:-back]) & (owner[back:] == owner[:-back])
    return np.bincount(owner[echo & word], minlength=n_texts), np.bincount(owner[word], minlength=n_texts)


def vectors(table: TokenTable, texts: list[str]):
    """Flat (text, bucket, value) triples of all texts, without summing up."""
    hashes, counts = table.lookup(texts)
    owners, buckets, values = [], [], []
    for whole, bucket, of in ngram_buckets(hashes, counts):
        per = np.bincount(of, minlength=len(texts))
        owners.append(of)
        buckets.append(bucket)
        values.append((SCALE / np.maximum(per, 1))[of])
    owner = np.repeat(np.arange(len(texts)), counts)
    for mark in (_mark("distinct", _distinct(whole, of, len(texts)), np.bincount(of, minlength=len(texts))),
                 _mark("echo", *_echoes(hashes, owner, len(texts)))):
        owners.append(np.arange(len(texts)))
        buckets.append(mark)
        values.append(np.ones(len(texts)))
    return np.concatenate(owners), np.concatenate(buckets), np.concatenate(values)


def train(sample: list[tuple[str, int]]) -> Model:
    """FTRL-proximal over the sample, in an order that its texts fix."""
    order = sorted(range(len(sample)), key=lambda i: (zlib.crc32(sample[i][0].encode("utf-8", "surrogatepass")), sample[i]))
    table, rows = token_table(), []
    for a, b in groups([sample[i][0] for i in order]):
        owner, bucket, value = vectors(table, [sample[i][0] for i in order[a:b]])
        key, back = np.unique(owner * (1 << BITS) + bucket, return_inverse=True)
        summed = np.bincount(back, weights=value)
        cut = np.searchsorted(key >> BITS, np.arange(b - a + 1))
        rows += [(key[cut[k]:cut[k + 1]] & ((1 << BITS) - 1), summed[cut[k]:cut[k + 1]]) for k in range(b - a)]
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(PASSES):
        for (buckets, values), k in zip(rows, order):
            i, x = np.r_[buckets, 1 << BITS], np.r_[values, 1.0]  # the last place is the bias
            w = weight(i)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - sample[k][1]) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    w = weight(np.arange(len(z)))
    used = np.flatnonzero(w[:-1])
    return Model(used, w[used], float(w[-1]))


def scores(table: TokenTable, dense: np.ndarray, bias: float, texts: list[str]) -> np.ndarray:
    owner, bucket, value = vectors(table, texts)
    dot = np.bincount(owner, weights=dense[bucket] * value, minlength=len(texts)) + bias
    return 1.0 / (1.0 + np.exp(-np.clip(dot, -35, 35)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", out: str = "score") -> DataFrame:
    """``(key, score)`` of every document."""
    need(docs, [key, text])
    rows = docs.select(key, text)
    schema = T.StructType([rows.schema[key], T.StructField(out, T.DoubleType(), False)])

    def batches(it):
        table, dense = token_table(), model.dense()
        for batch in it:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [scores(table, dense, model.bias, texts[a:b]) for a, b in groups(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(found) if found else np.zeros(0))], names=[key, out])

    return rows.mapInArrow(batches, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Model:
    """A model trained on the bounded sample of labelled documents."""
    return train(labelled_sample(docs, labels, label, PER_CLASS, MAX_CHARS, key, text))
