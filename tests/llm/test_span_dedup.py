"""Span dedup against a plain restatement over sorted documents."""

import random

from scribal.llm import span_dedup as S


def plain(docs):
    """Texts after removal: every span is kept where (key, place) is least."""
    runs, where = {}, {}
    for k, t in docs:
        ends = S.sentence_ends(t)
        parts = [tuple(t[b:e].lower().split()) for b, e in zip([0, *ends], ends)]
        runs[k] = (ends, [])
        for i in range(len(parts)):
            j = i + S.LEAST_SENTENCES
            while j <= len(parts) and sum(map(len, parts[i:j])) < S.LEAST_WORDS:
                j += 1
            if j <= len(parts):
                runs[k][1].append((tuple(parts[i:j]), i, j))
                where.setdefault(tuple(parts[i:j]), []).append((k, i))
    out = {}
    for k, t in docs:
        ends, found = runs[k]
        gone = {s for run, i, j in found if min(where[run]) != (k, i) for s in range(i, j)}
        out[k] = ("".join(t[b:e] for s, (b, e) in enumerate(zip([0, *ends], ends)) if s not in gone), len(gone), len(ends))
    return out


def text(rng, sentences):
    return " ".join(" ".join(rng.choice(["ka", "Lo", "mi", "teran", "osre"]) + str(rng.randrange(40)) for _ in range(rng.randint(1, 14)))
                    + rng.choice([".", "!", ",", ".\n", "", ";"]) for _ in range(sentences))


def test_equals_plain_removal(frame):
    rng = random.Random(6)
    passages = [text(rng, 8) for _ in range(4)] + [" ".join(f"long{k}" for k in range(90))]
    docs = []
    for i in range(120):
        parts = [text(rng, rng.randint(0, 6)) for _ in range(3)]
        for p in rng.sample(passages, rng.randint(0, 2)):
            parts.insert(rng.randrange(4), rng.choice([p, p, p.upper(), p + " " + p]))
        docs.append((i, rng.choice([" ", "\n", " mid "]).join(parts)))
    docs += [(500, docs[3][1]), (501, ""), (502, "one. two. three."), (503, "x " * 5000)]
    out = S.remove_repeats(frame([(k, t, "s") for k, t in docs], "doc_id long, text string, doc string")).collect()
    expected = plain(docs)
    assert {r.doc_id: (r.text, r.n_removed, r.n_sentences) for r in out} == expected
    assert sum(n for _, n, _ in expected.values()) > 200
    assert all(bool(r.kept_by) == (r.n_removed > 0) for r in out)


def test_planted_passage_and_clean_texts(frame):
    rng = random.Random(7)
    passage = " ".join(f"pass{rng.randrange(1000)}{',' if k % 9 == 8 else ''}" for k in range(60))
    clean = {i: text(rng, 20) for i in range(30)}
    docs = [(i, t if i % 3 else t[:200] + " " + passage + " " + t[200:]) for i, t in clean.items()]
    out = {r.doc_id: r for r in S.remove_repeats(frame(docs)).collect()}
    assert out[0].n_removed == 0 and out[0].text == docs[0][1]
    for i, t in docs:
        if i % 3:
            assert out[i].text == t
        elif i:
            left = sum(w in out[i].text.split() for w in passage.split())
            assert out[i].kept_by == [0] and left < 25


def test_odd_rows(frame):
    long = "a b c d e f g h i j. k l m n o p q r s t. u v w."
    rows = [(1, long), (1, long), (2, None), (2, ""), (None, long), (None, "alone")]
    out = S.remove_repeats(frame(rows)).collect()
    assert len(out) == 6
    assert sorted((str(r.doc_id), str(r.text), r.n_removed) for r in out) == [
        ("1", long, 0), ("1", long, 0), ("2", "", 0), ("2", "None", 0), ("None", "alone", 0), ("None", "u v w.", 2)]
    assert S.remove_repeats(frame([])).count() == 0


def runs(text, n=50):
    words = (text or "").lower().split()
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}


def in_two(texts):
    """Runs of 50 words that two of the texts hold."""
    seen, twice = set(), set()
    for t in texts:
        mine = runs(t)
        twice |= mine & seen
        seen |= mine
    return twice


def test_no_run_of_fifty_words_is_left_in_two_texts(frame):
    """Passages of 50 words and more in mid-sentence, with and without marks, in other white space."""
    rng = random.Random(8)

    def words(n, marks, few=1000):
        return [f"q{rng.randrange(few)}" + (rng.choice(".,;") if rng.random() < marks else "") for _ in range(n)]

    passages = [words(50 + k % 4, marks, few) for k in range(24) for marks, few in [((0, 0.02, 0.06, 0.2)[k // 6], (1000, 12)[k % 2])]]
    sentences = [f"s{k}" for k in range(53)]  # 17 + 18 + 18 words, begun and ended inside sentences
    sentences[16] += "."
    sentences[34] += "."
    passages.append(sentences)
    docs = []
    for k, p in enumerate(passages):
        for copy in range(3):
            around = [words(rng.randint(0, 30), 0.05, 100_000) + [f"u{k}x{copy}x{side}"] for side in (0, 1)]
            gap = rng.choice([" ", "\n", "  "])
            docs.append((10 * k + copy, " ".join(around[0]) + gap + gap.join(p) + gap + " ".join(reversed(around[1]))))
    assert len(in_two(t for _, t in docs)) >= len(passages)
    out = {r.doc_id: r for r in S.remove_repeats(frame(docs)).collect()}
    assert not in_two(r.text for r in out.values())
    for k, t in docs:
        if k % 10:
            assert k - k % 10 in out[k].kept_by and out[k].n_removed
        # what stands around the passages stays
        assert set(w for w in t.split() if w[0] == "u") <= set(out[k].text.split())


def test_texts_of_one_key_or_none_are_documents_of_their_own(frame):
    rng = random.Random(9)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(10_000)}{'.' if k % 7 == 6 else ''}" for k in range(140)) for x in "abcd")
    for key in (5, None):
        rows = [(key, a + " " + b), (key, c + " " + b), (key, d), (1, d), (key, a + " " + b)]
        out = S.remove_repeats(frame(rows)).collect()
        texts = sorted((str(r.doc_id), r.text.strip()) for r in out)
        assert len(out) == 5 and ("1", d) in texts
        assert all(r.text == "" and r.kept_by == [1] for r in out if r.doc_id == key and r.n_removed == r.n_sentences)
        # b stays in one of the two texts, and clean sentences stay; equal rows are alike
        whole = {r.text for r in out if r.doc_id == key and r.n_removed == 0}
        cut = {r.text.strip() for r in out if r.doc_id == key and 0 < r.n_removed < r.n_sentences}
        assert (whole, cut) in [({a + " " + b}, {c}), ({c + " " + b}, {a})]
        assert all(r.kept_by == [key] for r in out if r.doc_id == key and 0 < r.n_removed < r.n_sentences)
        assert not any(x in t for t in cut for x in b.split())


def test_string_keys_and_clashing_columns(frame):
    passage = " ".join(f"Sentence {k} of the passage that is shared by two." for k in range(12))
    schema = "id string, text string, _mark string, _doc string, n_removed string, _spans int"
    rows = [("a", "First text. " + passage, "m", "d", "n", 1), ("b", "Second one. " + passage, "m", "d", "n", 2), ("c", "Short.", None, None, None, None)]
    out = {r["id"]: r for r in S.remove_repeats(frame(rows, schema), "id").collect()}
    assert [out["a"][c] for c in ("_mark", "_doc", "n_removed", "_spans")] == ["m", "d", "n", 1]
    assert out["a"].text == rows[0][1] and passage not in out["b"].text and out["b"]["n_removed_"] > 0 and out["b"].kept_by == ["a"]
    assert out["c"].text == "Short." and out["c"]["n_removed_"] == 0


def test_owners_meet_by_a_shuffle_hot_ones_apart(spark, monkeypatch):
    """What grows with the input is never sent to all tasks, and what is shuffled holds no hot hash."""
    monkeypatch.setattr(S, "HOT_PARTS", 4)
    rows = [(d, d % 3 if d % 2 else 100 + d // 2) for d in range(90)]
    spans = spark.createDataFrame(rows, "doc long, hash long")
    owners = spark.createDataFrame([(h, min(d for d, x in rows if x == h), sum(x == h for _, x in rows)) for h in {x for _, x in rows if x != 2}],
                                   "hash long, kept_by long, n long")
    out = S._owned(spans, owners, 50)
    least = {h: k for h, k, _ in (tuple(r) for r in owners.collect())}
    assert sorted((r.doc, r.hash, r.kept_by) for r in out.collect()) == [(d, h, least[h]) for d, h in rows if h in least]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
