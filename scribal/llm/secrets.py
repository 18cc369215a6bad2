"""Secret scans: fixed patterns plus sliding-window entropy.

Two kinds of findings. Base findings are matches of three fixed patterns
(assignments to a secret-like name, access keys, long hex strings). The
entropy scan looks at candidate strings, longest runs of the characters that
keys are written in: a window of fixed length slides over each candidate, the
counts of its characters are kept up to date one character in and one out, and
a window is a hit when its Shannon entropy reaches the threshold of its
character class. Touching hits merge to one span. Candidates on the allow-list, the
parts of candidates that hold an allowed word, and spans inside base findings are
left out.

Runs are found on whole Arrow buffers at once (a table of byte classes and the
edges of its runs), so texts without candidates cost a few array passes.

Defined results: a null text is an empty one and has no findings; a finding
never crosses two texts; a run of any length is scanned whole; repeated rows
get equal results. Only the key and text columns are used.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scribal.llm.common import need

# ---------------------------------------------------------------------------
# FIXED VALUES: base patterns, in the order of their kinds.
# ---------------------------------------------------------------------------
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")
_NAMES = ("passw", "secret", "token", "api")

#: Characters of candidate strings.
CANDIDATE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Least bits per character of a window, by the class of its characters. A
#: window of one letter case only is prose more often than a key and is no hit.
THRESHOLDS = {"hex": 3.0, "letters_digits": 3.6, "mixed_case": 4.0, "base64": 3.6}
#: Candidates that match one of these are known to be harmless.
ALLOW = (
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",  # identifiers in the UUID form
    r"(?i:(?:[-_=/+]|abcdefghijklmnopqrstuvwxyz|0123456789)*)",  # marks and alphabets written out; no nested repeats
    r"[A-Za-z]+([-_/][A-Za-z]+)+",  # words joined by dashes, underscores or slashes
)

#: Words that tell a made-up value. They speak for the part of a candidate that
#: holds them, between slashes and equals signs; the other parts stand alone.
ALLOW_WORDS = r"(?i:example|placeholder|changeme|dummy|your[-_]?(?:api|secret|token|key))"
_PART = re.compile(r"[^/=]+")

_IS_CANDIDATE = np.zeros(256, dtype=bool)
_IS_CANDIDATE[list(CANDIDATE)] = True
# bits of the classes: digit, a-f, g-z, A-F, G-Z, other
_CLASS = np.zeros(256, dtype=np.uint8)
for _bit, _chars in enumerate((b"0123456789", b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEF", b"GHIJKLMNOPQRSTUVWXYZ", b"+/_=-")):
    _CLASS[list(_chars)] = 1 << _bit


def _window_class(bits: int) -> str | None:
    digit, lower, upper, other = bits & 1, bits & 6, bits & 24, bits & 32
    if digit and (lower or upper) and not other and not bits & 20:
        return "hex" if not (lower and upper) else "letters_digits"
    if digit and (lower or upper):
        return "base64" if other or (lower and upper) else "letters_digits"
    if lower and upper:
        return "mixed_case"
    return None


def entropy_spans(run: bytes, window: int = WINDOW, thresholds: dict[str, float] | None = None) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``run`` whose entropy reaches the
    threshold of their class. Counts change by one character in, one out."""
    limits = THRESHOLDS if thresholds is None else thresholds
    if len(run) < window:
        return []
    # a window of n characters with counts c has entropy log2 n - sum(c log2 c) / n
    cost = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts = [0] * 256
    members = [0] * 6  # characters of each class in the window
    kind = _CLASS[np.frombuffer(run, dtype=np.uint8)].tolist()
    place = {1 << b: b for b in range(6)}
    total, spans = 0.0, []
    for i, c in enumerate(run):
        if i >= window:
            old = run[i - window]
            total += cost[counts[old] - 1] - cost[counts[old]]
            counts[old] -= 1
            members[place[kind[i - window]]] -= 1
        total += cost[counts[c] + 1] - cost[counts[c]]
        counts[c] += 1
        members[place[kind[i]]] += 1
        if i >= window - 1:
            name = _window_class(sum((members[b] > 0) << b for b in range(6)))
            if name is not None and math.log2(window) - total / window >= limits[name] - 1e-9:
                begin = i - window + 1
                if spans and spans[-1][1] >= begin:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((begin, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Findings of the base patterns in one text, in code points."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return out


def candidate_runs(data: np.ndarray, offsets: np.ndarray, least: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Per text, the byte spans (from the text's start) of its longest runs of
    candidate characters, from ``least`` characters on."""
    begin, end = int(offsets[0]), int(offsets[-1])
    mask = _IS_CANDIDATE[data[begin:end]]
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    if not len(mask):
        return out
    cut = np.zeros(len(mask) + 1, dtype=bool)  # a new text begins here
    cut[offsets - begin] = True
    before = np.r_[False, mask[:-1]]
    starts = np.flatnonzero(mask & (~before | cut[:-1]))
    after = np.r_[mask[1:], False]
    ends = np.flatnonzero(mask & (~after | cut[1:])) + 1
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    of = np.searchsorted(offsets - begin, starts, side="right") - 1
    for s, e, i in zip(starts.tolist(), ends.tolist(), of.tolist()):
        at = int(offsets[i]) - begin
        out[i].append((s - at, e - at))
    return out


class Scanner:
    """The scan with its parameters; ``scan`` gives (kind, start, end)."""

    def __init__(self, window: int = WINDOW, thresholds: dict[str, float] | None = None, allow: Iterable[str] = ALLOW,
                 allow_words: str = ALLOW_WORDS):
        self.window, self.thresholds = window, thresholds
        self.allow, self.allow_words = [re.compile(p) for p in allow], re.compile(allow_words)
        #: Shortest run of candidate characters that some finding may lie in.
        self.least = min(window, ACCESS_LEAST, HEX_LEAST)

    def _entropy(self, word: str) -> list[tuple[int, int]]:
        """Spans of one candidate that look random and are not allowed."""
        if any(p.fullmatch(word) for p in self.allow):
            return []
        if not self.allow_words.search(word):
            return entropy_spans(word.encode("ascii"), self.window, self.thresholds)
        out = []
        for part in _PART.finditer(word):
            if not self.allow_words.search(part[0]) and not any(p.fullmatch(part[0]) for p in self.allow):
                out += [(part.start() + a, part.start() + b) for a, b in entropy_spans(part[0].encode("ascii"), self.window, self.thresholds)]
        return out

    def scan(self, text: str, raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """``runs``: byte spans of the candidates in ``raw``, the text's UTF-8."""
        found: list[tuple[str, int, int]] = []
        lowered = text.lower()
        if any(n in lowered for n in _NAMES):
            found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        more = []
        plain = len(raw) == len(text)
        for s, e in runs:
            run = raw[s:e]
            at = s if plain else len(raw[:s].decode("utf-8"))
            word = run.decode("ascii")
            # whatever is long enough for these two lies within one candidate
            found += [("access", at + m.start(), at + m.end()) for m in ACCESS.finditer(word)
                      if m.end() - m.start() >= ACCESS_LEAST]
            found += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(word) if m.end() - m.start() >= HEX_LEAST]
            more += [(at + a, at + b) for a, b in self._entropy(word)]
        base = sorted((s, e) for _, s, e in found)
        found += [("entropy", s, e) for s, e in more if not any(a <= s and e <= b for a, b in base)]
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_SPAN = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False),
                      T.StructField("end", T.LongType(), False)])


def _text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    column = column.fill_null("")
    if column.offset or pa.types.is_large_string(column.type):
        column = pa.concat_arrays([column.cast(pa.large_string())]).cast(pa.large_string())
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), ends


def scan_batch(column: pa.Array, scanner: Scanner) -> list[list[tuple[str, int, int]]]:
    data, offsets = _text_buffers(column)
    runs = candidate_runs(data, offsets, scanner.least) if len(column) else []
    out = []
    for i in range(len(column)):
        raw = data[offsets[i]:offsets[i + 1]].tobytes()
        out.append(scanner.scan(raw.decode("utf-8"), raw, runs[i]))
    return out


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                 thresholds: dict[str, float] | None = None, allow: Iterable[str] = ALLOW,
                 allow_words: str = ALLOW_WORDS) -> DataFrame:
    """``(key, spans)``: all findings of every text, by start, then kind. The base
    findings are the same whatever the entropy scan's settings."""
    need(docs, [key, text])
    rows = docs.select(key, text)
    schema = T.StructType([rows.schema[key], T.StructField("spans", T.ArrayType(_SPAN, False), False)])
    settings = (window, dict(thresholds) if thresholds else None, tuple(allow), allow_words)
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def batches(it):
        scanner = Scanner(*settings)
        for batch in it:
            for a in range(0, len(batch), 1000):
                part = batch.slice(a, 1000)
                found = scan_batch(pa.concat_arrays([part.column(1)]), scanner)
                spans = pa.array([[dict(kind=k, start=s, end=e) for k, s, e in f] for f in found], arrow)
                yield pa.RecordBatch.from_arrays([part.column(0), spans], names=[key, "spans"])

    return rows.mapInArrow(batches, schema)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in the text column replaced by ``mark``
    (overlapping findings by one mark). Other columns and nulls stay."""
    need(docs, [key, text])
    at = docs.columns.index(text)
    names = docs.columns

    def batches(it):
        scanner = Scanner()
        for batch in it:
            for a in range(0, len(batch), 1000):
                part = batch.slice(a, 1000)
                column = pa.concat_arrays([part.column(at)])
                out = []
                for value, spans in zip(column.to_pylist(), scan_batch(column, scanner)):
                    done, kept = 0, []
                    for _, s, e in spans:
                        if s >= done:
                            kept += [value[done:s], mark]
                        done = max(done, e)
                    out.append("".join([*kept, value[done:]]) if spans else value)
                columns = [pa.array(out, part.schema.field(at).type) if i == at else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(batches, docs.schema)

