"""Mixing: targets by repeated resharing, copies by one plain running sum."""

import hashlib
import random

from scribal.llm import mixing as M


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = cap * sizes[s]
            left -= cap * sizes[s]
        free -= full
    return target


def test_mix(frame):
    rng = random.Random(4)
    sources = ["a", "b", "B", None, "hot", "hot", "hot", "é", "empty"]
    rows = []
    for i in range(3000):
        s = rng.choice(sources)
        text = None if s == "empty" or rng.random() < 0.02 else "w " * rng.choice([0, 1, 5, 5, 40, 300])
        rows.append((i if i % 50 else 7, text, s, 1))
    docs = frame(rows, "doc_id long, text string, source string, size int")
    out = M.mix(docs).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in out if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert abs(mine[0].target - targets[s]) < 1e-6
        # the plain running sum over the whole source
        units = int(targets[s] / sizes[s] * M.UNIT) if sizes[s] else 0
        name = "null" if s is None else "s" + s
        at = int(hashlib.md5(f"{M.SEED}/{name}".encode()).hexdigest()[:6], 16)
        expected = []
        for size, key in sorted((r.size, r.doc_id) for r in mine):
            expected.append((size, key, (at + units >> M.UNIT_BITS) - (at >> M.UNIT_BITS)))
            at += units
        assert sorted(expected) == sorted((r.size, r.doc_id, r.copies) for r in mine)
        assert abs(sum(r.size * r.copies for r in mine) - targets[s]) <= 600
        assert all(0 <= r.copies <= 2 for r in mine)
    assert sorted(map(str, out)) == sorted(map(str, M.mix(docs.repartition(7)).collect()))


def test_empty_and_blank(frame):
    schema = "doc_id long, text string, source string"
    assert M.mix(frame([], schema)).count() == 0
    out = M.mix(frame([(1, None, None), (2, "", "x")], schema)).collect()
    assert {(r.size, r.target, r.copies) for r in out} == {(0, 0.0, 0)}


def test_other_columns_come_back(frame):
    schema = "doc_id long, text string, source string, _text_mark string, _key string, _MARK long, _source string, _copies int, _copy int, size int"
    rows = [(k, " ".join(["w"] * 30), "a", "m", "k", k, "s", 9, 8, 7) for k in range(20)]
    out = M.emit(frame(rows, schema))
    assert out.columns == [c.split()[0] for c in schema.split(", ")] and {tuple(r) for r in out.collect()} <= set(rows)
