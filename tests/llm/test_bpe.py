"""BPE against the tokenizers library: ids and decoded text, odd texts included."""

import random

import pytest

from scribal.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "é", "é", "Σ", "ς", "İ", "ß", "'s", "'ll", "'", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "​",
         "1", "½", "!", "…", "<|endoftext|>", "<|startoftext|>", "<|", "ﬁ", "漢", "😀", "́", "the", "ing", "'S", "\x00",
         "_", "aaa", "가", "㈀"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def check(texts, library):
    encoder = bpe.Encoder(bpe.load(PATH))
    ids, upto = encoder.encode(texts)
    for i, ref in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = ids[upto[i]:upto[i + 1]]
        assert own.tolist() == ref.ids, texts[i][:80]
        assert bpe.decode_ids(encoder.bpe, own) == library.decode(ref.ids, skip_special_tokens=False)


def test_random_texts(library):
    rng = random.Random(5)
    check(["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(4000)], library)


def test_long_words_and_empty(library):
    check(["", " \n ", "a" * 3000, "ab" * 2000, "!" * 2000, "the " * 5000], library)


def test_forgetting_keeps_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    encoder = bpe.Encoder(bpe.load(PATH))
    for text in ["one two three four five", "five six one", "seven one eight"]:
        ids, _ = encoder.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_frame(frame, library):
    rows = [(1, "The cat sat."), (2, None), (3, ""), (3, "tie row"), (None, "x")]
    docs = frame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, list(r.ids)) for r in out) == sorted(
        (i or 0, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert all(r.decoded == library.decode(list(r.ids), skip_special_tokens=False) for r in out)
    assert bpe.encode(frame([]), PATH).count() == 0
