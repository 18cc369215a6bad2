"""Tensored MinHash against all pairs of full sets."""

import random

import numpy as np
import pytest

from scribal.llm import minhash as M
from scribal.llm.shingles import Shingler
from test_ngram_join import checked_again, corpus, shifted, shingle_sets


def brute(keys, texts, percent=80, width=2):
    """(key, size, least key reachable by links); None is the last key."""
    sets = shingle_sets(texts, width)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    order = [(k is None, k or 0) for k in keys]
    least = {}
    for i, k in enumerate(order):
        least[find(i)] = min(k, least.get(find(i), k))
    name = [least[find(i)] if s else order[i] for i, s in enumerate(sets)]
    return sorted(((k, len(s), None if n[0] else n[1]) for k, s, n in zip(keys, sets, name)), key=str)


def rows_of(out):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


@pytest.mark.parametrize("probes, percent", [(5, 80), (0, 85)])
def test_equals_all_pairs(frame, monkeypatch, probes, percent):
    monkeypatch.setattr(M, "PROBES", probes)  # without probes every link comes from the open buckets
    monkeypatch.setattr(M, "BLOCK", 16)
    rng = random.Random(probes + percent)
    texts = [*corpus(rng, 400), None, "", " \n", "A b", "a B", "É x", "é x", "one", "ONE", "x " * 3000, "x " * 2999]
    keys = [None if rng.random() < 0.1 else k for k in range(100, 100 + len(texts))]
    out = M.near_duplicates(frame([(k, t, 9) for k, t in zip(keys, texts)], "doc_id long, text string, size long"), percent=percent).collect()
    assert rows_of(out) == brute(keys, texts, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_hot_group_chain_and_repeated_rows(frame, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 8)
    rng = random.Random(3)
    base = [f"v{k}" for k in range(120)]
    rows = []
    for i in range(60):  # near copies of one text, of which two are often too far apart
        words = list(base)
        for _ in range(4):
            words[rng.randrange(120)] = f"x{rng.random()}"
        rows.append((i, " ".join(words)))
    rows += [(300 + k, " ".join([f"c{j}" for j in range(k, 100 + k)])) for k in range(0, 20, 5)]  # a chain
    rows += [(500, rows[0][1])] * 10 + [(500, "another text under the same key"), (None, rows[0][1]), (None, "alone in here")]
    out = M.near_duplicates(frame(rows)).collect()
    assert rows_of(out) == brute([k for k, _ in rows], [t for _, t in rows])
    kept = M.keep_one(frame(rows)).collect()
    names = {r.component_id for r in out}
    assert len(kept) == len({(r.doc_id, r.text) for r in kept}) and {r.doc_id for r in kept} <= names | {None}


def test_linked_sets_are_not_compared_again(frame, monkeypatch):
    docs = frame(shifted(80))
    assert checked_again(monkeypatch, M, lambda: M.near_duplicates(docs)) == []


def test_labels_meet_nodes_not_their_rows_by_tables(frame, monkeypatch):
    rng = random.Random(8)
    rows = shifted(40)  # links are found in every round
    for i in range(40):  # near copies, many of them too far apart from each other
        words = [f"v{k}" for k in range(100)]
        for _ in range(rng.randrange(9)):
            words[rng.randrange(100)] = f"x{rng.random()}"
        rows.append((100 + i, " ".join(words)))
    met, members, real, pairs_with = [], [], M.labelled, M.against_one
    monkeypatch.setattr(M, "labelled", lambda rows, labels: met.append(rows.count()) or real(rows, labels))
    monkeypatch.setattr(M, "against_one", lambda rows, *rest: members.append(rows.count()) or pairs_with(rows, *rest))
    out = M.near_duplicates(frame(rows)).collect()
    assert rows_of(out) == brute([k for k, _ in rows], [t for _, t in rows])
    assert len(met) > 2 and max(met) <= len(rows)
    assert len(members) > 1 and max(members[1:]) <= M.COLLECTIONS * len(rows)


def test_empty_and_clashing_columns(frame):
    assert M.near_duplicates(frame([])).collect() == []
    assert M.keep_one(frame([])).collect() == []
    schema = "doc_id long, text string, sig string, _mark long, _KEY string, label string"
    rows = [(1, "a b c", "x", 5, "k", "l"), (2, "A b c", "y", 6, "m", None), (3, None, None, None, None, None), (4, None, None, None, None, None)]
    assert sorted(map(tuple, M.keep_one(frame(rows, schema)).collect())) == [rows[0], rows[2], rows[3]]
    keyed = frame([("b", "x y z"), ("a", "x y z"), ("c", "p q")], "id string, body string")
    assert sorted(map(tuple, M.near_duplicates(keyed, "id", "body").select("id", "component_id").collect())) == [("a", "a"), ("b", "a"), ("c", "c")]


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(4)
    for s in (0.8, 0.9, 0.3):
        n = 400
        common = int(2 * n * s / (1 + s))
        both = np.unique(rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64))
        rng.shuffle(both)
        a, b = np.sort(both[:n]), np.sort(both[n - common:])
        sig = M.signatures(np.concatenate([a, b, a[:0]]), np.array([len(a), len(b), 0]))
        assert abs((sig[0] == sig[1]).mean() - s) < 0.25 and not sig[2].any()
        keys = M.collection_keys(sig)
        assert ((keys[0] == keys[1]) == (sig[0] == sig[1]).reshape(M.COLLECTIONS, M.ROWS).all(axis=1)).all()
    values, counts = Shingler(2).sets([b"a b c", b"A B C", b"", b"a"])
    sig = M.signatures(values, counts)
    assert (sig[0] == sig[1]).all() and not sig[2].any()


def test_misses_are_rare():
    """Pairs just above the bar agree in two collections at least."""
    rng = np.random.default_rng(6)
    n, common, missed = 90, 80, 0  # 80 of 100
    sets = rng.integers(0, 1 << 63, (3000, 100), dtype=np.uint64)
    a, b = sets[:, :n], sets[:, n - common:]
    counts = np.full(len(sets), n)
    x = M.signatures(a.ravel(), counts).reshape(len(sets), M.COLLECTIONS, M.ROWS)
    y = M.signatures(b.ravel(), counts).reshape(len(sets), M.COLLECTIONS, M.ROWS)
    missed = ((x == y).all(axis=2).sum(axis=1) < 2).sum()
    assert missed == 0
