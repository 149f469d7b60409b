"""Words and their hashes of whole Arrow batches of text, in numpy.

A word is a run of bytes other than space and TAB to CR; these are ASCII, so the bytes of UTF-8 text
split as its characters do. A word's 64-bit hash takes in its bytes eight at a time, each step a bijection
of what came before (so that no two words of up to eight bytes and equal length share it). Hashes only choose
candidates: whoever links or removes text compares words, or cryptographic digests of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
FACTOR = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: All ASCII characters but letters and digits part these; other characters are taken as letters.
NO_LETTER = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
SLICE_BYTES = 1 << 20
#: Masks of the first bytes of eight, and the longest word that is taken in eight bytes at a time.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
_LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _eight(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first `size` bytes, at most eight, from each place as a number. data ends in eight spare bytes."""
    x = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)[at]).view("<u8").ravel()
    return x & _FIRST[np.minimum(size, 8)]


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes. data ends in eight spare bytes."""
    size = end - start
    h = mix(size.astype(U) * U(0xD6E8FEB86659FD93) + U(FACTOR))
    if not len(h):
        return h
    h = mix(h ^ _eight(data, start, size))
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = U(int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little"))
    more = np.flatnonzero((size > 8) & (size <= _LONG))
    step = 8
    while len(more):
        h[more] = mix((h[more] * U(FACTOR)) ^ _eight(data, start[more] + step, size[more] - step))
        step += 8
        more = more[size[more] > step]
    return h


@dataclass
class Words:
    """The words of some documents: document d has words first[d] to first[d + 1] (exclusive)."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    row: int
    offsets: np.ndarray
    folded: np.ndarray

    def begin(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the `size` bytes, at most eight, from places of the batch."""
        return mix(_eight(self.folded, at, np.full(len(at), size)) ^ U(size * FACTOR & 0xFFFFFFFFFFFFFFFF))

    def normal(self) -> Iterator[bytes]:
        """Each document's words, joined by one space."""
        text = self.folded.tobytes()
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            yield b" ".join(text[a:b].split())

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, offsets, bytes) of consecutive parts of a string column; nulls are empty texts.

    A part has at most `most` bytes unless one text alone is longer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary())
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to - at, offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]]
        at = to


def words(column: pa.Array, lower: bool = False, most: int = SLICE_BYTES, space: np.ndarray = _SPACE) -> Iterator[Words]:
    """Words of consecutive parts of a string column."""
    for row, n, offsets, data in slices(column, most):
        solid = ~space[data]
        edge = np.zeros(len(data) + 1, bool)  # a word starts here, if solid
        edge[offsets[:-1]] = True
        edge[1:] |= np.append(~solid, False)[: len(data)]
        start = np.flatnonzero(solid & edge[:-1])
        stop = np.ones(len(data), bool)  # a word ends after this byte, if solid
        if len(data):
            stop[:-1] = ~solid[1:]
            ends = offsets[1:] - 1
            stop[ends[ends >= 0]] = True
        end = np.flatnonzero(solid & stop) + 1
        folded = np.zeros(len(data) + 8, np.uint8)
        folded[: len(data)] = _LOWER[data] if lower else data
        yield Words(_spans(folded, start, end), np.searchsorted(start, offsets), start, end, data, row, offsets, folded[: len(data) + 8])


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of a followed by b."""
    x = (a + b) * U(FACTOR)
    return x ^ (x >> U(29))


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position, and whether they lie in one document. Same length as w.hash."""
    n = len(w.hash)
    out = np.zeros(n, U)
    if n >= k:
        acc = np.zeros(n - k + 1, U)
        for j in range(k):
            acc = chain(acc, w.hash[j : n - k + 1 + j])
        out[: n - k + 1] = mix(acc ^ U(k))
    return out, in_one(w, k)


def in_one(w: Words, k: int) -> np.ndarray:
    """Whether the k words from each position lie in one document."""
    n = len(w.hash)
    whole = np.zeros(n, bool)
    if n >= k:
        whole[: n - k + 1] = True
    for j in range(1, k):  # too near a document's end
        at = w.first[1:] - j
        at = at[(at >= w.first[:-1]) & (at < n)]
        whole[at] = False
    return whole


def long_list(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.ascontiguousarray(values).view(np.int64)))


def digests(texts: Iterator[bytes]) -> np.ndarray:
    """128-bit cryptographic digests, as rows of two longs."""
    return np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), np.int64).reshape(-1, 2)


class Exact:
    """Numbers for words and for runs of words that are equal if, and only if, the words are: no hash stands for them."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def words(self, texts: list[bytes]) -> list[np.ndarray]:
        """Numbers of the words of each text."""
        number = self.known.setdefault
        return [np.array([number(x, len(self.known)) for x in t.split()], np.int64) for t in texts]

    def runs(self, words: list[np.ndarray], k: int) -> list[np.ndarray]:
        """Distinct numbers of each text's runs of k words, of all its words if it has fewer, none if it has none."""
        short = [x if 0 < len(x) < k else None for x in words]
        at = np.cumsum([0] + [max(0, len(x) - k + 1) for x in words])
        most = max(1, len(self.known))
        run = np.concatenate([x[: len(x) - k + 1] for x in words if len(x) >= k] or [np.zeros(0, np.int64)])
        top = most
        for j in range(1, k):
            nxt = np.concatenate([x[j : len(x) - k + 1 + j] for x in words if len(x) >= k] or [np.zeros(0, np.int64)])
            if top * most >= 1 << 62:  # number the runs so far anew, so that the next word fits
                distinct, run = np.unique(run, return_inverse=True)
                top = max(1, len(distinct))
            run = run * most + nxt
            top *= most
        named: dict[tuple, int] = {}
        out = []
        for i, s in enumerate(short):
            if s is None:
                out.append(np.unique(run[at[i] : at[i + 1]]))
            else:  # below zero, as no longer run is
                out.append(np.array([-1 - named.setdefault(tuple(s.tolist()), len(named))], np.int64))
        return out
