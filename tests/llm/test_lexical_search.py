"""Ranked search against scoring every document, with ties, stops and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from scribal.llm import lexical_search as S

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in _TERM.findall(text or "")]


def brute(docs, items, k=10):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, total = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = 0
            for t in set(plain_terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def corpus(rng, n):
    vocabulary = ["The", "of", "né", "x1", "Ünd", "ße", *[f"t{k}" for k in range(200)]]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    texts = [rng.choice([" ", "-", ", ", "\n", "_"]).join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 20, 80, 400]))) for _ in range(n)]
    return texts + texts[: n // 5]  # ties by whole copies


@pytest.mark.parametrize("shard, depth", [(7, 1), (50, 2), (4096, 8)])
def test_equals_scoring_all(frame, monkeypatch, shard, depth):
    monkeypatch.setattr(S, "SHARD_DOCS", shard)
    monkeypatch.setattr(S, "FIRST_DEPTH", depth)
    rng = random.Random(shard)
    texts = corpus(rng, 250)
    docs = list(enumerate(texts)) + [(900, None), (901, ""), (902, " - _"), (None, texts[3]), (903, "the " * 5000)]
    items = [(i, " ".join(rng.choice(texts).split()[: rng.choice([1, 5, 40])])) for i in range(30)]
    items += [(50, None), (51, "?!"), (52, "nowhere to be found"), (53, "THE the The")]
    rows = frame([(d, t, 0, "k") for d, t in docs], "doc_id long, text string, score int, key string")
    found = S.search(rows, frame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute(docs, items), key=str)


def test_blocks_of_items_and_other_keys(frame, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ITEMS", 2)
    rng = random.Random(4)
    texts = corpus(rng, 40)
    docs = [(f"d{k:03d}", t) for k, t in enumerate(texts)]
    items = [(f"q{i}", texts[i]) for i in range(5)]
    found = S.search(frame(docs, "d string, body string"), frame(items, "q string, text string"), "d", "body", "q", k=3).collect()
    assert sorted(map(tuple, found)) == sorted(brute(docs, items, 3))
    with pytest.raises(ValueError):
        S.search(frame(docs, "id string, text string"), frame(items, "id string, text string"), "id", "text", "id")


def test_empty_tables(frame):
    items = frame([(1, "a b")], "item_id long, text string")
    assert S.search(frame([]), items).collect() == []
    assert S.search(frame([(1, "a b")]), items.limit(0)).collect() == []
    assert S.search(frame([(1, None)]), items).collect() == []


def test_stops_strictly_below():
    """Documents that tie with the k-th score are all candidates, and a shard that cannot reach the floor is not read."""
    ids = np.zeros(40, dtype=np.int64)
    shard = S._Shard(ids, np.arange(40), np.full(40, 5), 1, 40)
    docs, scores = shard.best(np.array([0]), 3, 0)
    assert len(docs) == 40 and set(scores) == {5}
    assert len(shard.best(np.array([0]), 3, 6)[0]) == 0
    falling = S._Shard(ids, np.arange(40), np.arange(40, 0, -1), 1, 40)
    assert 3 <= len(falling.best(np.array([0]), 3, 0)[0]) < 8
