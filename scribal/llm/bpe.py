"""BPE encoding and decoding in batched numpy merge rounds.

The vocabulary file (the tokenizers library's JSON) is read by its path, which
is a parameter; nothing of it is copied. Words of many texts are encoded at
once: their symbols lie in one flat array, and in every round the pairs of all
words are looked up by binary search over the sorted pair keys, each word's
lowest-ranked pair is merged wherever it occurs, and words without a known
pair leave the array. A bounded table of words already met carries over from
one batch to the next.

Handled vocabularies: BPE over byte symbols with an end-of-word suffix, NFC,
white space, lower case, and a pattern that keeps letter runs, single digits,
English contractions and runs of other marks (the "word_bpe" kind). Special
tokens found in a text become their ids, as the library does.

Defined results: a null or blank text has no tokens and decodes to an empty
text. Long words merge every occurrence of the best pair per round, so a round
shortens them; texts are never cut. Repeated rows get equal results. Only the
key and text columns are used.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scribal.llm.common import need, unused

#: White space as the vocabulary's patterns understand it (Unicode White_Space).
_CHUNK = re.compile("[^\t-\r \x85\xa0  -     　]+")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Characters of text encoded together, and words remembered between batches.
CHARS_AT_ONCE = 1_000_000
WORDS_KEPT = 300_000
_NONE = np.iinfo(np.int64).max


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordBpe:
    """One vocabulary: its pair table, byte symbols and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or not suffix or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("the vocabulary must be a plain BPE with an end-of-word suffix")
        vocab = model["vocab"]
        self.size = len(vocab) + len(spec["added_tokens"])
        self.names = np.empty(max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, dtype=object)
        for name, i in vocab.items():
            self.names[i] = name
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for name, i in self.special.items():
            self.names[i] = name
        self.special_split = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        keys, merged = [], []
        for left, right in model["merges"]:
            keys.append(vocab[left] * self.size + vocab[right])
            merged.append(vocab[left + right])
        keys, rank = np.array(keys, dtype=np.int64), np.arange(len(keys), dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], rank[order]
        self.merged = np.array(merged, dtype=np.int64)
        symbols = _byte_symbols()
        self.inner = np.array([vocab[symbols[b]] for b in range(256)], dtype=np.int64)
        self.final = np.array([vocab[symbols[b] + suffix] for b in range(256)], dtype=np.int64)

    def pieces(self, chunk: str) -> list[str | int]:
        """The pre-tokens of one run of non-space characters; special tokens
        come as their ids."""
        if self.special_split is not None and "<" in chunk and self.special_split.search(chunk):
            out: list[str | int] = []
            for part in self.special_split.split(chunk):
                out += [self.special[part]] if part in self.special else self.pieces(part) if part else []
            return out
        # one capital at a time: the last sigma of a word is not special here
        text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        return _PIECE.findall(text)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's ids begin."""
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(lens)
        sym = self.inner[raw]
        sym[ends - 1] = self.final[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lens)
        done_sym, done_owner = [], []
        while len(sym):
            best = np.full(len(words), _NONE)
            pair = np.full(len(sym), _NONE)
            if len(sym) > 1:
                key = sym[:-1] * self.size + sym[1:]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
                pair[:-1][known] = self.ranks[at[known]]
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                best[owner[first]] = np.minimum.reduceat(pair, first)
            low = best[owner]
            active = low != _NONE
            if not active.all():  # finished words leave
                done_sym.append(sym[~active])
                done_owner.append(owner[~active])
                sym, owner, pair, low = sym[active], owner[active], pair[active], low[active]
            if not len(sym):
                break
            hit = pair == low
            # overlapping hits (as in "aaa"): every second one, from the left
            at = np.flatnonzero(hit)
            start = np.r_[True, at[1:] != at[:-1] + 1]
            base = np.maximum.accumulate(np.where(start, at, 0))
            at = at[(at - base) % 2 == 0]
            sym[at] = self.merged[low[at]]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, owner = sym[keep], owner[keep]
        sym, owner = np.concatenate(done_sym or [sym]), np.concatenate(done_owner or [owner])
        order = np.argsort(owner, kind="stable")
        return sym[order].astype(np.int32), np.r_[0, np.cumsum(np.bincount(owner, minlength=len(words)))]


def _gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches flat[starts[i]:starts[i]+counts[i]], one after another."""
    ends = np.cumsum(counts)
    out = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
    return flat[out]


class Encoder:
    """Encodes texts in batches and remembers a bounded number of chunks."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.empty(0, dtype=np.int32)
        self.starts = np.empty(0, dtype=np.int64)
        self.counts = np.empty(0, dtype=np.int64)

    def _learn(self, chunks: list[str]) -> None:
        pieces = [self.bpe.pieces(c) for c in chunks]
        number = {w: i for i, w in enumerate(dict.fromkeys(p for ps in pieces for p in ps if isinstance(p, str)))}
        ids, begin = self.bpe.merge([w.encode("utf-8") for w in number]) if number else (self.ids[:0], np.zeros(1, int))
        # special tokens follow the merged words in the same flat array
        special = {i: len(number) + k for k, i in enumerate(sorted(self.bpe.special.values()))}
        flat = np.r_[ids, np.array(sorted(special), dtype=np.int32)]
        begin = np.r_[begin, begin[-1] + 1 + np.arange(len(special))]
        of = np.fromiter((number[p] if isinstance(p, str) else special[p] for ps in pieces for p in ps), dtype=np.int64)
        per = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        counts = begin[of + 1] - begin[of]
        new = _gather(flat, begin[of], counts)
        upto = np.r_[0, np.cumsum(counts)][np.r_[0, np.cumsum(per)]]
        self.starts = np.r_[self.starts, len(self.ids) + upto[:-1]]
        self.counts = np.r_[self.counts, np.diff(upto)]
        self.ids = np.r_[self.ids, new]
        base = len(self.index)
        self.index.update(zip(chunks, range(base, base + len(chunks))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin."""
        found = [_CHUNK.findall(t) for t in texts]
        if len(self.index) > WORDS_KEPT:
            self._forget()
        new = [c for c in dict.fromkeys(c for cs in found for c in cs) if c not in self.index]
        if new:
            self._learn(new)
        get = self.index.__getitem__
        per = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        at = np.fromiter((i for cs in found for i in map(get, cs)), dtype=np.int64, count=int(per.sum()))
        counts = self.counts[at]
        upto = np.r_[0, np.cumsum(counts)][np.r_[0, np.cumsum(per)]]
        return _gather(self.ids, self.starts[at], counts), upto


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def decode_ids(bpe: WordBpe, ids: np.ndarray) -> str:
    """The text of ids: this kind of vocabulary has no decoder of its own, so
    the tokens' names are joined by spaces, as the library does."""
    return " ".join(bpe.names[ids].tolist())


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about CHARS_AT_ONCE characters."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHARS_AT_ONCE:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)``: the token ids of every text, special tokens not added."""
    need(docs, [key, text])
    rows = docs.select(key, text)
    schema = T.StructType([rows.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def batches(it):
        encoder = Encoder(load(path))
        for batch in it:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _groups(texts):
                ids, upto = encoder.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=[key, "ids"])

    return rows.mapInArrow(batches, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids as a last column, ``out`` or, if there is
    one of that name, the next one unused; special tokens are kept."""
    [out] = unused(encoded, out)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType(), False)])
    at = encoded.columns.index(ids)

    def batches(it):
        bpe = load(path)
        for batch in it:
            lists = batch.column(at)
            step = max(1, min(len(lists), 256))
            for a in range(0, len(lists), step):
                part = lists.slice(a, step)
                flat, upto = part.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(
                    part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
                texts = [decode_ids(bpe, flat[upto[i]:upto[i + 1]]) for i in range(len(part))]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, step) for c in batch.columns), pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(batches, schema)
