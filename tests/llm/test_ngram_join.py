"""The n-gram join against all pairs, on copies, chains, short and odd texts."""

import random

import numpy as np
import pytest

from scribal.llm import ngram_join as J
from scribal.llm.bitmaps import Bitmaps, bitmap
from scribal.llm.common import written
from scribal.llm.links import linked
from scribal.llm.shingles import Shingler


def shingle_sets(texts, width=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width
                   else frozenset([tuple(w)] if w else []))
    return out


def brute(keys, texts, percent=85):
    sets = shingle_sets(texts)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        least[find(i)] = min(k, least.get(find(i), k))
    return sorted((k, len(s), least[find(i)] if s else k) for i, (k, s) in enumerate(zip(keys, sets)))


def corpus(rng, n):
    vocabulary = [f"w{k}" for k in range(300)]
    common = " ".join(rng.choice(vocabulary) for _ in range(12))
    texts = []
    for _ in range(n):
        r = rng.random()
        if texts and r < 0.45:  # a near copy of an earlier text
            words = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(len(words) + 1)
                words[at:at + rng.randint(0, 1)] = [rng.choice(vocabulary)]
            texts.append(" ".join(words))
        else:
            size = rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 10, 12, 15, 20, 40, 90, 200])
            texts.append(" ".join(rng.choice(vocabulary) for _ in range(size)) + (" " + common if r > 0.8 else ""))
    return texts


@pytest.mark.parametrize("probes, percent", [(8, 85), (0, 60), (4, 80)])
def test_equals_all_pairs(frame, monkeypatch, probes, percent):
    monkeypatch.setattr(J, "PROBES", probes)  # without probes every link comes from the open tiles
    monkeypatch.setattr(J, "BLOCK", 16)
    texts = [*corpus(random.Random(probes + percent), 400), None, "", " \n", "A b", "a B", "É x", "é x", "a\x1cb c", "x " * 3000, "x " * 2999]
    keys = list(range(100, 100 + len(texts)))
    docs = frame([(k, t, 9) for k, t in zip(keys, texts)], "doc_id long, text string, size long")
    out = J.join_ngrams(docs, percent=percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute(keys, texts, percent)


def test_hot_group_and_repeated_rows(frame, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 8)
    rng = random.Random(3)
    base = [f"v{k}" for k in range(120)]
    rows = []
    for i in range(150):  # near copies of one text, each its own
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(200, rows[0][1])] * 40 + [(200, "another text under the same key"), (None, rows[0][1]), (None, "alone in here, no key")]
    out = J.join_ngrams(frame(rows)).collect()
    assert len(out) == len(rows)
    assert {r.component_id for r in out if r.doc_id is not None and r.n_shingles > 100} == {0}
    assert sorted(str(r.component_id) for r in out if r.doc_id is None) == ["0", "None"]
    assert J.join_ngrams(frame([])).count() == 0


def checked_again(monkeypatch, module, run):
    """Pairs that are put to the exact test although links found before connect them."""
    again, parent, exact = [], {}, module.exact_links

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    def recorded(pairs, *rest):
        again.extend((r.a, r.b) for r in pairs.collect() if find(r.a) == find(r.b))
        found = written(exact(pairs, *rest))
        for r in found.collect():
            parent[find(r.a)] = find(r.b)
        return found

    monkeypatch.setattr(module, "exact_links", recorded)
    assert run().collect()
    return again


def shifted(n, size=100):
    """A chain: texts that begin one word later than the one before."""
    return [(k, " ".join(f"c{j}" for j in range(k, size + k))) for k in range(n)]


def test_linked_sets_are_not_compared_again(frame, monkeypatch):
    docs = frame(shifted(80))
    assert checked_again(monkeypatch, J, lambda: J.join_ngrams(docs)) == []


def tiles_of(sets, percent):
    """Per kind and set its tiles, and how many it shares with each linked set."""
    found = J.tile_keys(np.concatenate(sets), np.array([len(s) for s in sets]), percent)
    return [([set(keys[owner == i].tolist()) for i in range(len(sets))], share) for owner, _, keys, share in found]


def random_set(rng, size):
    return np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))


@pytest.mark.parametrize("percent", [40, 50, 60, 67, 75, 80, 85, 95])
def test_linked_sets_share_tiles(percent):
    """Sets that link by a hair share as many tiles as said, whatever their sizes."""
    rng = np.random.default_rng(percent)
    for _ in range(300):
        a = random_set(rng, int(rng.integers(1, rng.choice([8, 40, 400]))))
        lost = int(rng.integers(0, max(1, (100 - percent) * len(a) // percent) + 1))
        drop = int(rng.integers(0, lost + 1)) if len(a) > lost else 0
        b = np.unique(np.r_[rng.permutation(a)[drop:], rng.integers(0, 1 << 63, lost - drop, dtype=np.uint64)])
        if not linked(a, b, percent) or np.array_equal(a, b):
            continue
        most = Bitmaps([bitmap(a), bitmap(b)]).most_common(np.array([0]), np.array([1]), np.array([len(a), len(b)]))[0]
        assert most >= len(np.intersect1d(a, b))
        small, big = sorted([a, b], key=len)
        own, below, prefix = tiles_of([small, big], percent)
        enough = False
        for kind in (own, below):  # in the band of the smaller one
            common = own[0][0] & kind[0][1]
            enough |= bool(common) and len(common) >= max(own[1][0], kind[1][1])
        assert enough or prefix[0][0] & prefix[0][1]


def test_unrelated_sets_do_not_meet():
    rng = np.random.default_rng(2)
    for size, percent in ((300, 80), (2000, 80), (2000, 85), (6000, 80), (30, 80)):
        sets = [random_set(rng, size - int(rng.integers(0, size // 10))) for _ in range(400 if size <= 2000 else 60)]
        met = 0
        for tiles, _ in tiles_of(sets, percent):
            holders = {}
            for i, keys in enumerate(tiles):
                for k in keys:
                    holders.setdefault(k, []).append(i)
            met += sum(len(h) * (len(h) - 1) // 2 for h in holders.values())
        assert met == 0


def test_few_sets_need_prefix_tiles():
    rng = np.random.default_rng(3)
    sets = [random_set(rng, int(rng.integers(5, 500))) for _ in range(500)]
    own, below, prefix = tiles_of(sets, 80)
    assert sum(bool(p) for p in prefix[0]) < 25 and sum(map(len, own[0])) < sum(map(len, sets)) / 2


def test_bitmaps_of_any_lengths_bound_from_above():
    rng = np.random.default_rng(9)
    sets = [random_set(rng, int(rng.integers(1, 3000))) for _ in range(40)]
    sets += [np.unique(np.r_[rng.choice(s, len(s) // 2), random_set(rng, 50)]) for s in sets]
    sizes = np.array([len(s) for s in sets])
    x, y = (v.ravel() for v in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    most = Bitmaps([bitmap(s) for s in sets]).most_common(x, y, sizes)
    shared = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y)])
    assert (most >= shared).all() and (most <= np.minimum(sizes[x], sizes[y])).all()
    assert (most[x == y] == sizes[x[x == y]]).all()


def test_odd_percent_is_refused(frame):
    for percent in (0, 101):
        with pytest.raises(ValueError):
            J.join_ngrams(frame([]), percent=percent)


def test_other_columns_come_back(frame):
    schema = "doc_id long, text string, _text_mark string, _mark long, _KEY string, _own int, label string, name string"
    rows = [(1, "a b c d e", "x", 5, "k", 1, "l", "n"), (2, "a b c d e", "y", 6, "m", 2, None, "o"), (3, None, None, None, None, None, None, None)]
    assert sorted(map(tuple, J.keep_one(frame(rows, schema)).collect())) == [rows[0], rows[2]]


def test_exact_threshold_and_shingles():
    a = np.arange(100, dtype=np.uint64)
    assert linked(a[:85], a, 85) and not linked(a[:84], a, 85) and not linked(a[:0], a[:0], 85)
    values, counts = Shingler(4).sets([b"a b c d a b c d", b"", b"A b", b"a b", b"a b c d"])
    assert counts.tolist() == [4, 0, 1, 1, 1] and values[4] == values[5]


def test_texts_without_a_key_are_linked_like_any(frame):
    """Near copies among rows without a key and of keyed ones, and as bridges, against all pairs."""
    rng = random.Random(11)
    texts = corpus(rng, 150)
    a = [f"b{k}" for k in range(100)]
    chain = [" ".join(["e", "f"][:n] + a[n:]) for n in (0, 1, 2)] + [" ".join(a[:-k] + ["g"] * k) for k in (1, 3, 6)]
    keys = [None if rng.random() < 0.4 else 7 if rng.random() < 0.3 else k for k in range(10, 160)] + [500, None, None, None, 501, None]
    texts += chain
    keys += [None] * 3 + [7] * 2
    texts += [chain[0]] * 3 + ["only this text " * 3] * 2
    order = [(k is None, k or 0) for k in keys]  # null comes last
    expected = sorted((str(k[1] if not k[0] else None), n, str(c[1] if not c[0] else None)) for k, n, c in brute(order, texts))
    rows = list(zip(keys, texts))
    out = J.join_ngrams(frame(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == expected
    near = [(None, " ".join(a)), (None, " ".join(["e", *a[1:]])), (3, " ".join(["e", "f", *a[2:]])), (None, "far from all of these")]
    assert sorted(str(r.doc_id) for r in J.keep_one(frame(near)).collect()) == ["3", "None"]
