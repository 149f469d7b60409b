"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings by character class.

A candidate is a run of at least 20 characters of [A-Za-z0-9+/_=-]. For each class (hex, base64) the
stretches of its characters are scanned with a window of fixed width whose character counts are kept
incrementally: sliding by one changes two counts, so H = log2(w) - sum(c log2 c) / w costs O(1) a
step. Windows at or above the class's floor are joined into spans. Spans that an allow-list pattern
covers (UUIDs, single-case letters, runs of one separator, counters) are suppressed; they never
suppress a base span.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")


@dataclass(frozen=True)
class Window:
    """A character class, the window's width, and the least bits a character of a window that counts."""

    kind: str
    chars: str
    width: int
    floor: float


WINDOWS = (
    Window("entropy_hex", r"[0-9a-fA-F]+", 24, 3.0),
    Window("entropy_base64", r"[A-Za-z0-9+/=_-]+", 20, 3.7),
)

#: Strings of high entropy that are no secrets.
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[a-z/_=+-]+",
    r"[A-Z/_=+-]+",
    r"[A-Z]?[a-z]+(?:[/_=+-]+[A-Z]?[a-z]+)*",
    r"[0-9/_=+-]+",
)
_SAME_CASE = re.compile("|".join(f"(?:{x})" for x in ALLOW))
_XLOG = [0.0] + [c * log2(c) for c in range(1, 257)]


def hot_windows(s: str, width: int, floor: float) -> list[tuple[int, int]]:
    """Maximal spans of s that windows of at least `floor` bits a character cover; counts are kept incrementally."""
    n = len(s)
    if n < width:
        return []
    count: dict[str, int] = {}
    total = 0.0
    for ch in s[:width]:
        c = count.get(ch, 0)
        count[ch] = c + 1
        total += _XLOG[c + 1] - _XLOG[c]
    most = (log2(width) - floor) * width + 1e-9
    out: list[list[int]] = []
    for at in range(n - width + 1):
        if at:
            gone, new = s[at - 1], s[at + width - 1]
            c = count[gone]
            count[gone] = c - 1
            total += _XLOG[c - 1] - _XLOG[c]
            c = count.get(new, 0)
            count[new] = c + 1
            total += _XLOG[c + 1] - _XLOG[c]
        if total <= most:
            if out and at <= out[-1][1]:
                out[-1][1] = at + width
            else:
                out.append([at, at + width])
    return [(a, b) for a, b in out]


_CLASSES = [(w, re.compile(w.chars)) for w in WINDOWS]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) of the fixed patterns: leftmost, non-overlapping in a kind, failing matches dropped."""
    out = []
    if _ASSIGN_WORDS.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    out.sort()
    return out


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for m in _CANDIDATE.finditer(text):
        whole = m[0]
        if _SAME_CASE.fullmatch(whole):
            continue
        for w, chars in _CLASSES:
            for part in chars.finditer(whole):
                if part.end() - part.start() < w.width:
                    continue
                for a, b in hot_windows(part[0], w.width, w.floor):
                    if not _SAME_CASE.fullmatch(part[0][a:b]):
                        at = m.start() + part.start()
                        out.append((at + a, KINDS.index(w.kind), at + b))
    out.sort()
    return out


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, n_entropy, base, spans) of every whole text.

    base and spans are "kind:start:end" joined by commas, by start, then kind, in code points, end
    exclusive. A null text is empty and has no spans. One row in, one row out: repeated rows are
    repeated, other columns are ignored. One pass, no shuffle.
    """
    names = [id_col, "n_assign", "n_access", "n_hex", "n_entropy", "base", "spans"]

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for x in b.column(1):
                text = x.as_py() or ""
                base = base_spans(text)
                more = entropy_spans(text)
                kinds = [k for _, k, _ in base]
                for c, v in zip(cols, (kinds.count(0), kinds.count(1), kinds.count(2), len(more), _join(base), _join(sorted(base + more)) if more else _join(base)), strict=True):
                    c.append(v)
            kinds_ = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds_, strict=True))], names=names)

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_entropy long, base string, spans string")


def redact(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span of any kind replaced by `mark`; overlapping spans are one. Other columns stay as they are.

    Null texts stay null.
    """
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            out = []
            for x in b.column(at):
                text = x.as_py()
                spans = sorted(base_spans(text) + entropy_spans(text)) if text else []
                if spans:
                    parts, done, end = [], 0, -1
                    for a, _, e in spans:
                        if a >= end:
                            parts += [text[done:a], mark]
                        end = done = max(end, e)
                    text = "".join(parts) + text[done:]
                out.append(text)
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return docs.mapInArrow(run, schema)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
