"""SimHash against a plain restatement; the search against all pairs."""

import hashlib
import random
import re
import struct
from collections import Counter

import xxhash

from scribal.llm import simhash as S


def plain_fingerprint(text):
    votes, total = [0] * 128, 0
    seed = xxhash.xxh64_intdigest(struct.pack("<i", 7), seed=42)
    for w in set(re.findall(r"[^\x20\x09-\x0D]+", text or "")):
        weight = min(len(w), 16)
        total += weight
        for h, s in ((0, 42), (1, seed)):
            value = xxhash.xxh64_intdigest(w.encode(), seed=s)
            for b in range(64):
                votes[64 * h + b] += weight * (value >> b & 1)
    return sum((2 * v > total) << b for b, v in enumerate(votes[:64])), sum((2 * v > total) << b for b, v in enumerate(votes[64:]))


def test_documents(frame):
    rng = random.Random(1)
    texts = [None, "", " \n", "one", "ü" * 40, "x y z " * 2000]
    texts += [" ".join(rng.choice(["the", "añb", "caterpillar", "zz", "😀x"]) + str(rng.randrange(60)) for _ in range(rng.randint(1, 150)))
              for _ in range(60)]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, "no key at all")]
    out = S.fingerprint_documents(frame([(k, t, 1) for k, t in rows], "doc_id long, text string, hi int")).collect()
    assert len(out) == len(rows)
    order = sorted({k: t for k, t in rows if k is not None}.items(), reverse=True) + [(None, "no key at all")]
    following = {k: order[(i + 1) % len(order)][1] or "" for i, (k, _) in enumerate(order)}
    text_of = {k: t or "" for k, t in rows}
    for r in out:
        text, after = text_of[r.doc_id], following[r.doc_id]
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        (a, b), (c, d), (e, f) = (plain_fingerprint(t) for t in (text, edited, after))
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == f"{a:016x}{b:016x}" and r.edited_fingerprint == f"{c:016x}{d:016x}"
        assert abs(r.near_edited - (1 - ((a ^ c).bit_count() + (b ^ d).bit_count()) / 128)) < 1e-12
        assert abs(r.near_next - (1 - ((a ^ e).bit_count() + (b ^ f).bit_count()) / 128)) < 1e-12


def test_few_and_no_rows(frame):
    assert S.fingerprint_documents(frame([])).count() == 0
    [one] = S.fingerprint_documents(frame([(5, "only one here")])).collect()
    assert one.near_next == 1.0
    two = S.fingerprint_documents(frame([(5, "one of two"), (5, "same key")])).collect()
    assert len(two) == 2 and len({r.edited_sha256 for r in two}) == 2


def test_search_equals_all_pairs(frame, monkeypatch):
    monkeypatch.setattr(S, "TILE", 8)
    rng = random.Random(2)

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    values = [rng.getrandbits(128) for _ in range(40)]
    for v in list(values):
        for _ in range(rng.choice([0, 1, 8, 20])):  # some clusters
            w = v
            for _ in range(rng.randint(0, 9)):
                w ^= 1 << rng.randrange(128)
            values.append(w)
    pairs = [(signed(v >> 64), signed(v & (2**64 - 1))) for v in values]
    pairs += pairs[:5] * 3  # copies
    stored = frame(pairs, "hi long, lo long")
    found = S.within_radius(frame(pairs[::3], "hi long, lo long"), stored).collect()
    got = {}
    for r in found:
        assert len(r.near) <= 8
        got.setdefault((r.q_hi, r.q_lo), []).extend((x.hi, x.lo, x.n) for x in r.near)
    copies = Counter(pairs)
    distinct = {(signed(v >> 64), signed(v & (2**64 - 1))): v for v in values}
    for q in set(pairs[::3]):
        expected = sorted((*p, copies[p]) for p, v in distinct.items() if (v ^ distinct[q]).bit_count() <= S.RADIUS)
        assert sorted(got.get(q, [])) == expected  # each neighbour once
