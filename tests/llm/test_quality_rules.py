"""Quality rules against a brute-force version and odd rows."""

import random
import re
import unicodedata
from collections import defaultdict

from scribal.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    covered = {q for places in at.values() if len(places) > 1 for p in places for q in range(p, p + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_figures(frame):
    rng = random.Random(1)
    texts = [None, "", " \n\t ", "a " * 9, "a " * 8, "ü\x0b\x1cé\xa0x", "x\ny\nx\n\n \n"]
    for _ in range(150):
        vocabulary = [f"w{k}" for k in range(rng.choice([2, 3, 50]))] + ["#", "|$", "über"]
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "  "]) for _ in range(rng.randint(0, 120))))
    texts += ["OK! really?? NO!! İ É é 9A A9 9 # x#y a| A&B !? ?! x!!y éÉ É", "A\u2028 B!!\u0085 ß ẞ Σσ", "word" * 3000 + "!! X"]
    docs = frame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, n_words double")
    out = {r.doc_id: r for r in Q.quality_rules(docs).collect()}
    for i, t in enumerate(texts):
        r = out[i]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(t), t
        assert r.base_failed == (got[0] < 20 or 100 * got[4] > 30 * got[0])
        assert not (r.kept and (r.base_failed or r.failed_rules))
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        marked = sum(bool(re.search(r"([#*$%&|<>]|[!?]{2,})\Z", w)) for w in words)
        capital = sum(any(unicodedata.category(c) == "Lu" for c in w) and not any(unicodedata.category(c) == "Ll" for c in w) for w in words)
        n = max(1, len(words))
        assert (r.marked_word_ratio, r.capital_word_ratio) == (marked / n, capital / n), t


def test_verdicts(frame):
    prose = " ".join(f"the word{k} of it" for k in range(30))
    docs = frame([(1, prose), (1, prose), (2, prose.upper()), (3, prose.replace(" ", " | ")), (4, None)])
    out = sorted((r.doc_id, r.kept) for r in Q.quality_rules(docs).collect())
    assert out == [(1, True), (1, True), (2, False), (3, False), (4, False)]
    assert Q.quality_rules(frame([])).count() == 0
    assert Q.quality_rules(docs, thresholds=[]).filter("kept").count() == 4
