"""The trained classifiers: held-out accuracy on planted labels, odd rows."""

import random
import re

import numpy as np
import pytest

from scribal.llm import labelled, quality_classifier, toxicity

SYLLABLES = ["ka", "lo", "mi", "ter", "an", "os", "re", "du", "ni", "bel"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    words = [word(rng) for _ in range(n)]
    return " ".join(w + rng.choice(["", "", "", ".", ","]) for w in words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(700):
        toxic, bad = int(rng.random() < 0.2), int(rng.random() < 0.3)
        text = prose(rng, rng.randint(20, 120))
        if toxic:
            words = text.split()
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["zorgish", "zorgan", "zorgos", "blarf", "Blarf!"]))
            text = " ".join(words)
        if bad:
            text = text.upper().replace(" ", "!! ") if rng.random() < 0.5 else " ".join(w for w in text.split() for _ in range(4))
        rows.append((i, text, 1 - bad, toxic))
    return rows


@pytest.fixture
def tables(frame, corpus):
    docs = frame([(i, t, "src", 1.0) for i, t, _, _ in corpus], "doc_id long, text string, source string, score double")
    labels = frame([(i, q, x, "clash") for i, _, q, x in corpus], "doc_id long, quality int, toxic int, text string")
    return docs, labels


def held_out_accuracy(corpus, scored, at, least):
    import zlib

    scores = {r.doc_id: r.score for r in scored}
    assert len(scores) == len(corpus) and all(0 <= s <= 1 for s in scores.values())
    test = [r for r in corpus if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    return np.mean([(scores[r[0]] >= least) == bool(r[at]) for r in test])


def test_quality(corpus, tables):
    model = quality_classifier.fit(*tables)
    assert held_out_accuracy(corpus, quality_classifier.score(tables[0], model).collect(), 2, 0.3) > 0.97


def test_toxicity(corpus, tables):
    model = toxicity.fit(*tables)
    scored = toxicity.score(tables[0], model).collect()
    assert held_out_accuracy(corpus, scored, 3, 0.5) > 0.97
    texts = {i: t for i, t, _, _ in corpus}
    found = [texts[r.doc_id][s.start:s.end] for r in scored for s in r.spans]
    assert found and np.mean([bool(re.search("zorg|blarf", w.lower())) for w in found]) > 0.97
    kept = {r.doc_id for r in toxicity.reject(tables[0], model).collect()}
    assert kept == {r.doc_id for r in scored if r.score < 0.5}


def test_held_out_rows_are_not_learned_from(tables, frame):
    import zlib

    sample = labelled.labelled_sample(*tables, "toxic", {0: 50, 1: 20}, 20_000)
    texts = {t: i for i, t in ((r.doc_id, r.text) for r in tables[0].collect())}
    assert 0 < len(sample) <= 70 and all(zlib.crc32(str(texts[t]).encode()) % 5 for t, _ in sample)
    assert sample == labelled.labelled_sample(tables[0].repartition(5), tables[1], "toxic", {0: 50, 1: 20}, 20_000)
    repeated = frame([(1, "same text", "s", 0.0)] * 500, "doc_id long, text string, source string, score double")
    one = frame([(1, 1, 1, "")], "doc_id long, quality int, toxic int, text string")
    assert len(labelled.labelled_sample(repeated, one, "toxic", {1: 20}, 100)) <= 40


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_odd_rows(module, tables, frame):
    model = module.fit(*tables)
    rows = [(1, None), (2, ""), (3, " \n..! "), (None, "x"), (4, "one two"), (4, "one two"), (5, "word " * 30_000)]
    out = module.score(frame(rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 4}) == 1
    assert module.score(frame([]), model).count() == 0
    none = module.fit(tables[0], tables[1].limit(0))
    assert module.score(frame(rows), none).count() == len(rows)
