"""The pipeline's stages on a small table, each against its own restatement."""

import random
from collections import Counter

import pytest

import corpus_pipeline as P
from scribal.llm import bpe, mixing, ngram_join, secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ter", "an", "os"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", ".", ""])
                    for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(400):
        text = prose(rng, rng.randint(10, 80))
        toxic = rng.random() < 0.2
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorgish", "zorgan", "blarf"]))
            text = " ".join(words)
        if rng.random() < 0.1:
            text += ' token = "4aee7877f816035eb54cd1071cacad463aef45b3" end'
        rows.append((i, text, "en", rng.choice(["a", "b", "hot", "hot", None]), len(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + k, rows[k][1], "en", "hot", rows[k][4]) for k in range(30)]
    rows += [(2000, None, None, "a", None), (2001, "", "en", "b", 0), rows[5], (None, "no key here", "en", "a", 11)]
    base = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outputs = []
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        outputs.append(docs)
        if k < 4:
            assert docs.columns == COLUMNS
    given = rows_of(spark.read.parquet(f"{folder}/documents.parquet"))
    clean, unique, safe, mixed = (rows_of(o) for o in outputs[:4])
    # toxicity: toxic documents go, the others stay
    bad = {r for r in given if r[1] and ("zorg" in r[1] or "blarf" in r[1])}
    assert not clean - given and sum(n for r, n in clean.items() if r in bad) <= 2
    assert sum(n for r, n in (given - clean).items() if r not in bad) <= 2
    # near duplicates: one row of each component, wordless rows stay
    joined = ngram_join.join_ngrams(spark.read.parquet(f"{tmp_path}/0"), width=5, percent=80).collect()
    assert not unique - clean and set(unique.values()) == {1}
    names = {r.component_id for r in joined if r.n_shingles}
    assert sorted(map(str, (r[0] for r in unique))) == sorted(map(str, names | {r.doc_id for r in joined if not r.n_shingles}))
    # secrets: same rows, no finding left
    assert sorted(map(str, (r[0] for r in safe))) == sorted(map(str, (r[0] for r in unique)))
    assert not any(secrets.base_spans(r[1] or "") for r in safe)
    assert all(r[4] == len(r[1]) for r in safe if r[1] is not None)
    assert {r for r in unique if not secrets.base_spans(r[1] or "")} <= set(safe)
    # mixing: the copies that the operator decides
    decided = Counter()
    for r in mixing.mix(spark.read.parquet(f"{tmp_path}/2")).collect():
        decided[r.doc_id] += r.copies
    assert Counter(r[0] for r in mixed.elements()) == +decided
    # bpe: one row per document, ids decode to what was encoded
    last = outputs[4]
    assert last.count() == sum(mixed.values())
    model = bpe.load(P.bpe_path())
    texts = {r[0]: r[1] or "" for r in mixed}
    encoder = bpe.Encoder(model)
    for r in last.collect()[:50]:
        assert encoder.encode([texts[r.doc_id]])[0].tolist() == list(r.ids) and r.n_tokens == len(r.ids)


def test_repeated_rows_and_empty_table(spark, folder):
    rows = [(1, "a b c d e f", "x", "s", 11)] * 3 + [(1, "other text here", "x", "s", 15)] * 2 + [(2, "a b c d e f", "x", None, 11), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = rows_of(ngram_join.keep_one(docs))
    assert kept == Counter({rows[0]: 1, rows[3]: 1, rows[6]: 1})
    emitted = Counter(r[0] for r in rows_of(mixing.emit(docs)).elements())
    decided = Counter()
    for r in mixing.mix(docs).collect():
        decided[r.doc_id] += r.copies
    assert emitted == +decided
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        empty_out = stage(spark, empty, folder)
        assert empty_out.count() == 0


def test_run(spark, folder):
    assert P.run(spark, folder).count() > 0
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "bpe"]


def test_near_copies_between_the_settings(spark, folder):
    """Pairs of a five-word similarity from 0.80 on but a four-word one under 0.85 are near duplicates of the stage."""

    def similarity(a, b, width):
        x, y = ({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} for w in (a.split(), b.split()))
        return len(x & y) / len(x | y)

    scattered = [f"w{k}" for k in range(1000)]
    changed = [f"x{k}" if k % 45 == 20 else w for k, w in enumerate(scattered)]
    block = [f"v{k}" for k in range(200)]
    replaced = [f"y{k}" if 90 <= k < 107 else w for k, w in enumerate(block)]
    far = [f"z{k}" if k % 40 == 20 else w for k, w in enumerate(scattered)]
    pairs = [(" ".join(scattered), " ".join(changed)), (" ".join(block), " ".join(replaced))]
    for a, b in pairs:
        assert similarity(a, b, 4) < 0.85 and 0.80 <= similarity(a, b, 5) < 0.85
    assert similarity(" ".join(scattered), " ".join(far), 5) < 0.80
    texts = [t for p in pairs for t in p] + [" ".join(far)]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in enumerate(texts)], SCHEMA)
    stage = dict(P.STAGES)["near_duplicates"]
    assert sorted(r.doc_id for r in stage(spark, docs, folder).collect()) == [0, 2, 4]
