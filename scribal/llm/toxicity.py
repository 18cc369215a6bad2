"""Toxicity: a linear-chain CRF tags toxic tokens; marginals make scores.

Training (on a bounded labelled sample, ``PER_CLASS`` rows per label of at most
``MAX_CHARS`` characters):

1. Token labels. Labels mark documents, the chain needs marked tokens. Features
   of tokens (the word, its beginnings of several lengths) are counted over toxic
   and clean texts. A greedy cover picks, one after another, the feature that
   explains the most toxic texts not explained yet and that (nearly) no clean
   text has; other features as telling are added when they occur in many
   different contexts (copies of one text are one context). Tokens of toxic
   texts with a picked feature are labelled toxic.
2. The chain. Sequences are sentences: of ``CHAIN_TEXTS`` texts of each label
   those with a labelled token or a word that begins like one, and of all texts
   one in forty. A token's features are the word, its beginnings and its end; what is beside it counts
   through the transitions. Weights are fitted by maximum likelihood.

Scoring: every token of every whole text gets its marginal probability by
forward and backward sums. A document's score is the probability that one of
its tokens at least is toxic, over the tokens of some evidence (``EVIDENCE``);
tokens of 0.5 and more are the offending offsets, neighbours merged.

Defined results: a null text or one without words scores 0 with no spans; texts
of any length are used whole; repeated rows get equal results; without toxic
labels every score is 0. Labels, language, source and key are not features.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scribal.llm import crf
from scribal.llm.common import need
from scribal.llm.labelled import TokenTable, groups, labelled_sample

#: Sample bound: rows per label and characters per row.
PER_CLASS = {0: 6000, 1: 2500}
MAX_CHARS = 20_000
#: Texts of each label whose telling sentences train the chain.
CHAIN_TEXTS = 600
BEGINNINGS = range(4, 10)
#: A picked feature explains this many texts at least, and its share among
#: toxic texts is this many times its share among clean ones (smoothed, plain).
LEAST_TEXTS, LEAST_RATIO, LEAST_PLAIN_RATIO = 4, 20.0, 150.0
#: A clean text with the feature outweighs so many toxic ones (by share).
CLEAN_COST = 20.0
#: Contexts that make a telling feature count without the cover.
LEAST_CONTEXTS = 8
EVIDENCE = 0.5
#: Words, and what ends a sentence.
TOKEN = re.compile(r"[^\W_]+|[.!?\n]")
_END = frozenset(".!?\n")


def token_features(word: str) -> list[str]:
    """Features of one token: itself, its beginnings, its end."""
    w = word.lower()
    return ["w=" + w, *("b=" + w[:n] for n in BEGINNINGS if len(w) > n), "e=" + w[-3:]]


@lru_cache(maxsize=20_000)
def _candidates(word: str) -> list[str]:
    return [f for f in token_features(word) if f[0] != "e"]


def _sentences(text: str) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for w in TOKEN.findall(text):
        if w in _END:
            out.append([])
        else:
            out[-1].append(w)
    return [s for s in out if s]


def pick_features(sample: list[tuple[str, int]]) -> set[str]:
    """Telling features of toxic texts; texts are taken one at a time."""
    n_clean, n_toxic = (sum(1 for _, y in sample if y == k) for k in (0, 1))
    if not n_toxic or not n_clean:
        return set()

    def found(text: str) -> set[str]:
        return {f for w in {w for s in _sentences(text) for w in s} for f in _candidates(w)}

    often = Counter(f for text, y in sample if y for f in found(text))
    often = Counter({f: n for f, n in often.items() if n >= LEAST_TEXTS})
    clean = Counter(f for text, y in sample if not y for f in found(text) if f in often)
    telling = {f for f, n in often.items()
               if n / n_toxic >= LEAST_RATIO * (clean[f] + 0.5) / n_clean
               and n / n_toxic >= LEAST_PLAIN_RATIO * clean[f] / n_clean}
    toxic: list[set[str]] = []
    contexts: dict[str, set[str]] = {f: set() for f in telling}
    for text, y in sample:
        if y:
            toxic.append(set())
            for s in _sentences(text):
                for before, w in zip(["", *s], s):
                    for f in telling.intersection(_candidates(w)):
                        toxic[-1].add(f)
                        contexts[f].add(before)
    has: dict[str, list[int]] = {f: [] for f in telling}
    for i, s in enumerate(toxic):
        for f in s:
            has[f].append(i)
    picked = {f for f in telling if len(contexts[f]) >= max(LEAST_CONTEXTS, len(has[f]) / 4) and not clean[f]}
    open_now = Counter({f: len(at) for f, at in has.items()})
    explained = [False] * len(toxic)
    while open_now:
        # among equals the longer feature says it more exactly
        best = max(open_now, key=lambda f: (open_now[f] - CLEAN_COST * clean[f] * n_toxic / n_clean, len(f), f))
        if open_now[best] < LEAST_TEXTS:
            break
        picked.add(best)
        for i in has[best]:
            if not explained[i]:
                explained[i] = True
                for f in toxic[i]:
                    open_now[f] -= 1
        del open_now[best]
    return picked


@dataclass
class Model:
    """Weights by feature, and the chain's transition and start scores."""

    weight: dict[str, float]
    moves: np.ndarray
    start: np.ndarray

    def emission(self, tokens: list[str]) -> np.ndarray:
        """Scores of tokens; what ends a sentence is marked by NaN."""
        get = self.weight.get
        bias = get("bias", 0.0)
        return np.array([np.nan if t in _END else bias + sum(get(f, 0.0) for f in token_features(t)) for t in tokens],
                        dtype=np.float64)

    @property
    def chain(self) -> crf.Chain:
        return crf.Chain(np.empty(0), self.moves, self.start)


def train(sample: list[tuple[str, int]]) -> Model:
    """Token labels by cover, then the chain on sentences of the sample."""
    sample = list(dict.fromkeys(sample))
    picked = pick_features(sample)
    if not picked:
        return Model({"bias": -20.0}, np.zeros((2, 2)), np.zeros(2))
    words = {w for t, y in sample if y for s in _sentences(t) for w in s}
    marked = {w for w in words if not picked.isdisjoint(_candidates(w))}
    alike = {w[:4].lower() for w in marked}
    sequences: list[tuple[list[str], int]] = []
    left = {0: CHAIN_TEXTS, 1: CHAIN_TEXTS}
    for t, y in sample:
        whole, left[y] = left[y] > 0, left[y] - 1
        for k, s in enumerate(_sentences(t)):
            telling = any(w in marked for w in s) if y else any(w[:4].lower() in alike for w in s)
            if (telling and whole) or k % 40 == 0:
                sequences.append((s, y))
    seen = Counter(f for s, _ in sequences for w in s for f in token_features(w))
    number: dict[str, int] = {"bias": 0}
    ids_of: dict[str, list[int]] = {}
    ids, counts, tags = [], [], []
    for s, y in sequences:
        for w in s:
            if w not in ids_of:
                ids_of[w] = [0, *(number.setdefault(f, len(number)) for f in token_features(w) if seen[f] > 1 or f in picked)]
            ids += ids_of[w]
            counts.append(len(ids_of[w]))
            tags.append(int(y and w in marked))
    chain = crf.fit(np.array(ids, np.int64), np.array(counts, np.int64), np.array(tags, np.int64),
                    np.array([len(s) for s, _ in sequences]), len(number), rounds=60, l2=0.5, rate=0.3)
    weight = {f: float(chain.weights[k]) for f, k in number.items() if chain.weights[k]}
    return Model(weight, chain.moves, chain.start)


def marginals(model: Model, table: TokenTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Probability of every word of every text, and the words per text."""
    values, counts = table.lookup(texts)
    ends = np.isnan(values)
    owner = np.repeat(np.arange(len(texts)), counts)
    words = np.flatnonzero(~ends)
    # a sentence changes with its text and after every end mark
    sentence = (np.cumsum(ends) + owner)[words] if len(words) else words
    lengths = np.unique(sentence, return_counts=True)[1] if len(words) else words
    probability = crf.posteriors(model.chain, values[words], crf.Batch(lengths))[0]
    return probability, np.bincount(owner[words], minlength=len(texts))


def document_scores(probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 - product of (1 - p) over the tokens of some evidence, else the
    largest probability of a token; 0 without tokens."""
    out = np.zeros(len(counts))
    owner = np.repeat(np.arange(len(counts)), counts)
    strong = probability >= EVIDENCE
    none = np.log1p(-np.minimum(probability[strong], 1 - 1e-12))
    np.maximum.at(out, owner, probability)
    found = np.bincount(owner[strong], weights=none, minlength=len(counts))
    return np.where(found < 0, 1.0 - np.exp(found), out)


_SPAN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])


def _spans(text: str, probability: np.ndarray) -> list[dict[str, int]]:
    """Code-point spans of the tokens of 0.5 and more, neighbours merged."""
    out: list[dict[str, int]] = []
    last = -2
    places = (m for m in TOKEN.finditer(text) if m[0] not in _END)
    for k, (m, p) in enumerate(zip(places, probability.tolist())):
        if p >= 0.5:
            if last == k - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = k
    return out


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score, spans)`` of every document."""
    need(docs, [key, text])
    rows = docs.select(key, text)
    schema = T.StructType([rows.schema[key], T.StructField("score", T.DoubleType(), False),
                           T.StructField("spans", T.ArrayType(_SPAN, False), False)])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def batches(it):
        table = TokenTable(TOKEN, model.emission)
        for batch in it:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in groups(texts):
                probability, counts = marginals(model, table, texts[a:b])
                upto = np.r_[0, np.cumsum(counts)]
                found = document_scores(probability, counts)
                spans = [_spans(t, probability[upto[i]:upto[i + 1]]) if found[i] >= 0.5 else []
                         for i, t in enumerate(texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(found), pa.array(spans, arrow)], names=[key, "score", "spans"])

    return rows.mapInArrow(batches, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """A model trained on the bounded sample of labelled documents."""
    return train(labelled_sample(docs, labels, label, PER_CLASS, MAX_CHARS, key, text))


def reject(docs: DataFrame, model: Model, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that score ``threshold`` or more, in one pass."""
    need(docs, [key, text])
    at = docs.columns.index(text)

    def batches(it):
        table = TokenTable(TOKEN, model.emission)
        for batch in it:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            kept = [document_scores(*marginals(model, table, texts[a:b])) < threshold for a, b in groups(texts)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(batches, docs.schema)
