"""Runs against their definition, the query against a plain restatement."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from scribal.llm import runs as R
from scribal.llm.queries import QUERIES


def brute(words, least=12):
    """Every maximal stretch, by its definition, period after period."""
    out, taken = [], set()
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q) and (i, j + q) not in taken:
                out.append((i, j + q - i, q))
                taken.add((i, j + q))  # larger periods of one stretch are no smallest ones
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def texts(rng):
    out = []
    for _ in range(120):
        size = rng.choice([0, 1, 5, 11, 12, 13, 30, 80, 200])
        words = [f"w{rng.randrange(rng.choice([1, 2, 3, 6, 50]))}" for _ in range(size)]
        if rng.random() < 0.5 and size:
            at, q = rng.randrange(size), rng.randint(1, 9)
            words[at:at] = (words[at:at + q] * 12)[: rng.randint(1, 12 * q)]
        out.append(words)
    a, b = "a", "a b"  # Fibonacci words are full of runs
    for _ in range(11):
        a, b = b, b + " " + a
    return out + [b.split(), ["x"] * 500, ["x", "y"] * 200 + ["x"], (["x"] * 13 + ["y"]) * 9]


def test_against_the_definition(frame):
    rng = random.Random(1)
    found = texts(rng)
    rows = [(k, rng.choice([" ", "\n", "\t "]).join(w)) for k, w in enumerate(found)]
    rows += [(900, None), (None, " \n "), (None, "z " * 20), rows[-1], rows[-1], (7, "é é " * 15)]
    out = R.find_runs(frame([(k, t, "x") for k, t in rows], "doc_id long, text string, runs string")).collect()
    words_of = [(k, (t or "").encode().split()) for k, t in rows]
    expected = [(k, tuple(brute(w)), collapse([x.decode() for x in w], brute(w))) for k, w in words_of]
    assert sorted(((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in out), key=repr) == sorted(expected, key=repr)
    assert R.find_runs(frame([])).count() == 0


def test_least_length_and_chunks(monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 7)
    rng = np.random.default_rng(3)
    for least in (2, 4, 12):
        for size in (2, 3, 17, 60, 150):
            words = rng.integers(0, int(rng.integers(1, 5)), size)
            got = R.runs(np.r_[words, 99], least)
            assert [tuple(r) for r in got.tolist()] == brute(words.tolist(), least)


def test_long_texts():
    one = R.runs(np.r_[np.zeros(60_000, dtype=np.int64), 1])
    assert one.tolist() == [[0, 60_000, 1]]
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 40, 50_000)
    words[20_000:40_000] = words[20_000 + np.arange(20_000) % 700]
    assert R.runs(np.r_[words, -1]).tolist() == [[20_000, 20_000, 700]]


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, " ".join(w), "s") for k, w in enumerate(texts(rng))] + [(k, " ".join(f"v{rng.randrange(400)}" for _ in range(150)), "s") for k in range(500, 560)]
    rows += [(1000, None, None), (1001, "", ""), (None, "a b " * 10, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), rows


def test_query(spark, folder):
    path, rows = folder
    expected = []
    for doc_id, text, _ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        n = len(words)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        expected.append((doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                         hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
                         hashlib.sha256(collapse(words, found).encode()).hexdigest()))
    out = QUERIES["op11_runs"](spark, path)
    assert dict(out.dtypes)["n_runs"] == "bigint"
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.select(*columns).collect()), key=str) == sorted(expected, key=str)
    assert any(e[0] is not None and e[0] >= 500 and e[1] for e in expected)  # some texts are made periodic
